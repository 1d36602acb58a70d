"""Column expressions over texts: content, paths, shell words.

All are built from native functions and stay in the JVM.  Null inputs give null
unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.plans.codes import CONTENT_MARK, CONTENT_MARK_MORE, COPY_NAME, SCRIPT_MARK, SCRIPT_MARK_MORE, SCRIPT_NAME, TESTBED_MARK

NUL = "\x00"


def json_value(text: Column) -> Column:
    """``text`` as a variant; null if it isn't JSON; text holding JSON is read again."""
    once = F.try_parse_json(text)
    return F.when(F.schema_of_variant(once) == "STRING", F.try_parse_json(F.try_variant_get(once, "$", "string"))).otherwise(once)


def kind_of(value: Column) -> Column:
    """string, null, array, object, scalar or missing."""
    shape = F.schema_of_variant(value)
    return F.when(value.isNull(), "missing").when(shape == "STRING", "string").when(shape == "VOID", "null").when(shape.startswith("ARRAY"), "array").when(shape.startswith("OBJECT"), "object").otherwise("scalar")


def items(value: Column) -> Column:
    """A variant's array items; empty for anything else."""
    empty = F.array().cast("array<variant>")
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), value.cast("array<variant>")).otherwise(empty)


def field(value: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, f"$['{name}']", kind)


def text_field(value: Column, name: str) -> Column:
    """A string member; null if it is of another type."""
    inner = field(value, name)
    return F.when(kind_of(inner) == "string", F.try_variant_get(inner, "$", "string"))


def content_text(message: Column) -> Column:
    """The text of a message's content: itself, its text blocks by newlines, or empty."""
    content = field(message, "content")
    texts = F.transform(F.filter(items(content), lambda b: field(b, "type", "string") == "text"), lambda b: F.coalesce(text_field(b, "text"), F.lit("")))
    return F.when(kind_of(content) == "string", F.try_variant_get(content, "$", "string")).when(kind_of(content) == "array", F.array_join(texts, "\n")).otherwise("")


def message_text(message: Column) -> Column:
    """Reasoning, text and thinking in order by blank lines, empties dropped;
    null where a part is no text (see ``message_text_error``)."""
    content = field(message, "content")
    part = F.transform(items(content), lambda b: F.coalesce(F.when(field(b, "type", "string") == "thinking", text_field(b, "thinking")).otherwise(text_field(b, "text")), F.lit("")))
    parts = F.when(kind_of(content) == "array", part).when(kind_of(content) == "string", F.array(F.try_variant_get(content, "$", "string"))).otherwise(F.array().cast("array<string>"))
    whole = F.concat(F.array(F.coalesce(text_field(message, "reasoning_content"), F.lit(""))), parts)
    return F.when(message_text_error(message).isNull(), F.array_join(F.filter(whole, lambda x: x != ""), "\n\n"))


def message_text_error(message: Column) -> Column:
    """Why a message has no text; null if it has."""
    content, reasoning = field(message, "content"), field(message, "reasoning_content")
    block = F.filter(items(content), lambda b: F.coalesce(~field(b, "type", "string").isin("text", "thinking"), F.lit(True)))
    kind = F.when(F.size(block) > 0, F.when(kind_of(block[0]) != "object", F.lit("NON_TEXT_CONTENT_BLOCK")).otherwise(F.concat(F.lit("NON_TEXT_CONTENT_BLOCK:"), F.coalesce(field(block[0], "type", "string"), F.lit("None")))))
    odd_reasoning = ~kind_of(reasoning).isin("missing", "null", "string")
    return F.when(odd_reasoning, "NON_TEXT_REASONING").when(~kind_of(content).isin("missing", "null", "string", "array"), "NON_TEXT_CONTENT").otherwise(kind)


def declared_root(text: Column) -> Column:
    """The repository path declared in the user and system texts of a session."""
    text = F.replace(text, F.lit("\\n"), F.lit("\n"))
    named = F.coalesce(F.nullif(F.regexp_extract(text, r"<uploaded_files>\s*(/[^\n<]+)", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"Cloned path:\s*(/[^\n]+)", 1), F.lit("")))
    return F.coalesce(F.regexp_replace(named, r"^\s+|\s+$", ""), F.when(F.contains(text, F.lit(TESTBED_MARK)), "/testbed"))


def absolute(path: Column, cwd: Column) -> Column:
    """The path, made absolute by an absolute cwd; ``..`` is kept.  Null where
    ``absolute_error`` has a reason."""
    joined = F.when(cwd.endswith("/"), F.concat(cwd, path)).otherwise(F.concat(cwd, F.lit("/"), path))
    return F.when(absolute_error(path, cwd).isNull(), F.when(path.startswith("/"), path).otherwise(joined))


def absolute_error(path: Column, cwd: Column) -> Column:
    bad = path.isNull() | (path == "") | F.contains(path, F.lit(NUL))
    return F.when(bad, "INVALID_PATH").when(~path.startswith("/") & ~F.coalesce(cwd.startswith("/"), F.lit(False)), "RELATIVE_PATH_REQUIRES_SOURCE_CWD")


def shell_word(value: Column) -> Column:
    """POSIX quoting of one word; null if it holds a NUL."""
    quoted = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("'\"'\"'")), F.lit("'"))
    return F.when(F.contains(value, F.lit(NUL)), None).when(value == "", "''").when(value.rlike(r"^[A-Za-z0-9_@%+=:,./-]+\z"), value).otherwise(quoted)


def lines(text: Column) -> Column:
    """Lines as Python's splitlines gives them."""
    parts = F.split(F.regexp_replace(text, "\r\n", "\n"), "[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def free_mark(mark: Column, suffix: str, text: Column) -> Column:
    """``mark`` with suffixes until no line of ``text`` is it: at most as many as
    there are lines that begin with it."""

    def first_free(own: Column, taken: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(0), F.size(taken)), lambda n: F.concat(own, F.repeat(F.lit(suffix), n)))
        return F.filter(tries, lambda m: ~F.array_contains(taken, m))[0]

    return _let(mark, lambda own: _let(F.filter(lines(text), lambda x: x.startswith(own)), lambda taken: first_free(own, taken)))


def write_command(path: Column, content: Column) -> Column:
    """Shell text that writes exactly ``content``."""

    def made(path: Column, content: Column) -> Column:
        mark = free_mark(F.concat(F.lit(CONTENT_MARK), F.substring(F.sha2(content.cast("binary"), 256), 1, 16)), CONTENT_MARK_MORE, content)
        document = _let(mark, lambda m: F.concat(F.lit("cat > "), shell_word(path), F.lit(" <<'"), m, F.lit("'\n"), content, m))
        printed = F.concat(F.lit("printf '%s' "), shell_word(content), F.lit(" > "), shell_word(path))
        return F.when(content.endswith("\n") & ~F.contains(content, F.lit(NUL)), document).otherwise(printed)

    return _let(F.struct(path.alias("path"), content.alias("content")), lambda v: made(v["path"], v["content"]))


def subshell(body: Column) -> Column:
    """A subshell of ``body``, with a no-op if it holds no command."""
    busy = F.exists(lines(body), lambda x: (F.regexp_replace(x, r"^\s+|\s+$", "") != "") & ~F.regexp_replace(x, r"^\s+", "").startswith("#"))
    return F.when(~F.contains(body, F.lit(NUL)), F.concat(F.lit("(\n"), body, F.when(busy, "").otherwise("\n:"), F.lit("\n)")))


def login_shell(body: Column) -> Column:
    mark = free_mark(F.lit(SCRIPT_MARK), SCRIPT_MARK_MORE, body)
    script = _let(mark, lambda m: F.concat(F.lit(f"(\nIFS= read -r -d '' {SCRIPT_NAME} <<'"), m, F.lit("' || :\n"), body, F.lit("\n"), m, F.lit(f'\nbash -lc "${{{SCRIPT_NAME}%?}}"\n)')))
    return F.when(~F.contains(body, F.lit(NUL)), script)


def sed_text(value: Column, replacement: bool = False) -> Column:
    """``value`` as a literal of sed's basic expressions or replacements."""
    special = r"([\\&|])" if replacement else r"([\\.\[*^$|])"
    return F.replace(F.regexp_replace(value, special, r"\\$1"), F.lit("\n"), F.lit("\\n"))


def replace_everywhere(path: Column, old: Column, new: Column) -> Column:
    find, at = sed_text(old), shell_word(path)
    test = shell_word(F.concat(F.lit("\\|"), find, F.lit("|q0; $q1")))
    change = shell_word(F.concat(F.lit("s|"), find, F.lit("|"), sed_text(new, True), F.lit("|g")))
    guard = F.concat(F.lit("( test -f "), at, F.lit(" && test -s "), at, F.lit(" && LC_ALL=C sed -z -n "), test, F.lit(" -- "), at)
    stage = F.concat(F.lit(f" || exit $?; {COPY_NAME}=$(mktemp) || exit $?; trap 'rm -f -- \"${COPY_NAME}\"' EXIT; LC_ALL=C sed -z "), change, F.lit(" -- "), at)
    return F.when(old != "", F.concat(guard, stage, F.lit(f' > "${COPY_NAME}" && cat -- "${COPY_NAME}" > '), at, F.lit(" )")))


def delete_command(path: Column) -> Column:
    return F.concat(F.lit("test -f "), shell_word(path), F.lit(" && rm -- "), shell_word(path))


def occurrences(text: Column, part: Column) -> Column:
    """Times a filled ``part`` occurs in ``text`` without overlap."""
    return F.when(part != "", ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int"))


def replaces_exactly(target: Column, before: Column, old: Column, new: Column) -> Column:
    """Whether a native one-place replacement has this literal effect."""
    everything = F.concat(before, old, new)
    return (old != "") & (old != new) & (occurrences(before, old) == 1) & ~F.contains(everything, F.lit("\r")) & ((target != "sweagent") | ~F.contains(everything, F.lit("\t")))


def first_line(text: Column) -> Column:
    """The first filled line, trimmed, at most 120 characters; null if none."""
    trimmed = F.transform(lines(text), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.substring(F.try_element_at(F.filter(trimmed, lambda x: x != ""), F.lit(1)), 1, 120)


def plan_status(reason: Column, requirements: Column) -> Column:
    return F.when(reason.isNotNull() & (reason != ""), "unsupported").when(F.size(requirements) > 0, "conditional").otherwise("ready")


def unexpected_keys(arguments: Column, allowed: list[str]) -> Column:
    """Sorted names of a JSON object's text that are not ``allowed``."""
    return F.array_sort(F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, allowed))))
