"""Shell text for file operations.  The text is data and is never run here."""

from __future__ import annotations

import hashlib
import shlex

from quern.plans.codes import CONTENT_MARK, CONTENT_MARK_MORE, COPY_NAME, SCRIPT_MARK, SCRIPT_MARK_MORE, SCRIPT_NAME, Refusal


def word(value: object) -> str:
    """``value`` as one shell word."""
    if not isinstance(value, str) or "\0" in value:
        raise Refusal("SHELL_ARGUMENT_MUST_BE_NUL_FREE_TEXT")
    return shlex.quote(value)


def line(words: list[str]) -> str:
    return " ".join(word(w) for w in words)


def body_text(body: object) -> str:
    if not isinstance(body, str) or "\0" in body:
        raise Refusal("INVALID_SHELL_BODY")
    return body


def absolute(path: object, cwd: str | None) -> str:
    """``path`` made absolute by ``cwd``; ``..`` is kept, as links may matter."""
    if not isinstance(path, str) or path == "" or "\0" in path:
        raise Refusal("INVALID_PATH")
    if path[0] == "/":
        return path
    if not cwd or cwd[0] != "/":
        raise Refusal("RELATIVE_PATH_REQUIRES_SOURCE_CWD")
    return cwd + path if cwd.endswith("/") else f"{cwd}/{path}"


def _free_mark(mark: str, suffix: str, text: str) -> str:
    taken = set(text.splitlines())
    while mark in taken:
        mark += suffix
    return mark


def write_file(path: str, content: str) -> str:
    """Writes exactly ``content``: a here-document if it ends with a newline."""
    quoted = word(content)
    if not content.endswith("\n"):
        return f"printf '%s' {quoted} > {word(path)}"
    mark = _free_mark(CONTENT_MARK + hashlib.sha256(content.encode("utf-8", "surrogatepass")).hexdigest()[:16], CONTENT_MARK_MORE, content)
    return f"cat > {word(path)} <<'{mark}'\n{content}{mark}"


def subshell(body: str) -> str:
    """A subshell of ``body``, which gets a no-op if it holds no command."""
    text = body_text(body)
    idle = all(part == "" or part[0] == "#" for part in (x.strip() for x in text.splitlines()))
    return "(\n" + text + ("\n:" if idle else "") + "\n)"


def login_shell(body: str) -> str:
    """``body`` as the literal script of a login shell, with its own stdin."""
    text = body_text(body)
    mark = _free_mark(SCRIPT_MARK, SCRIPT_MARK_MORE, text)
    return f"(\nIFS= read -r -d '' {SCRIPT_NAME} <<'{mark}' || :\n{text}\n{mark}\nbash -lc \"${{{SCRIPT_NAME}%?}}\"\n)"


def sed_text(value: str, replacement: bool = False) -> str:
    """``value`` as a literal of sed's basic expressions or replacements."""
    word(value)
    table = {ord(c): "\\" + c for c in ("\\&|" if replacement else "\\.[*^$|")} | {10: "\\n"}
    return value.translate(table)


def replace_everywhere(path: str, old: str, new: str) -> str:
    """Replaces all of ``old``, guarded by a match, through the same inode."""
    if old == "":
        raise Refusal("EMPTY_REPLACE_PATTERN")
    find, at = sed_text(old), word(path)
    test = word(f"\\|{find}|q0; $q1")
    change = word(f"s|{find}|{sed_text(new, True)}|g")
    return (
        f"( test -f {at} && test -s {at} && LC_ALL=C sed -z -n {test} -- {at} || exit $?; "
        f"{COPY_NAME}=$(mktemp) || exit $?; trap 'rm -f -- \"${COPY_NAME}\"' EXIT; "
        f'LC_ALL=C sed -z {change} -- {at} > "${COPY_NAME}" && cat -- "${COPY_NAME}" > {at} )'
    )


def delete_file(path: str) -> str:
    return f"test -f {word(path)} && rm -- {word(path)}"


def replaces_exactly(keeps_tabs: bool, before: str, old: str, new: str) -> bool:
    """Whether a native one-place replacement has this literal effect."""
    if old in ("", new) or before.count(old) != 1:
        return False
    everything = before + old + new
    return "\r" not in everything and (keeps_tabs or "\t" not in everything)
