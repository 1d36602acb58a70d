"""Path globs as regular expressions: braces, ``**``, ``*``, ``?`` and escapes."""

from __future__ import annotations

import re

from quern.plans.codes import Refusal

#: Most alternatives of one pattern.
MAX_ALTERNATIVES = 64
_BRACES = re.compile(r"(?<!\\)\{")
_TOKEN = re.compile(r"(?P<tree>(?<![^/])\*\*/)|(?P<rest>(?<![^/])\*\*$)|(?P<star>\*)|(?P<one>\?)|(?P<escaped>\\.)|(?P<bad>[\[\]{}])|(?P<dangling>\\$)|(?P<text>[^*?\\\[\]{}]+)", re.S)
_PART = {"tree": "(?:[^/]+/)*", "rest": ".*", "star": "[^/]*", "one": "[^/]"}


def expand(pattern: str) -> list[str]:
    """The alternatives of a pattern's braces; nesting isn't supported."""
    done, todo = [], [pattern]
    while todo:
        current = todo.pop(0)
        opening = _BRACES.search(current)
        if opening is None:
            done.append(current)
        else:
            head, _, tail = current[: opening.start()], "{", current[opening.end() :]
            body, closed, tail = tail.partition("}")
            choices = body.split(",")
            if not closed or "{" in body or len(choices) < 2 or "" in choices:
                raise Refusal("GLOB_BRACE_SYNTAX_UNSUPPORTED")
            todo = [head + c + tail for c in choices] + todo
        if len(done) + len(todo) > MAX_ALTERNATIVES:
            raise Refusal("GLOB_EXPANSION_LIMIT")
    return done


def _translate(pattern: str) -> str:
    out = [] if "/" in pattern else [_PART["tree"]]
    for m in _TOKEN.finditer(pattern):
        kind = m.lastgroup
        if kind == "bad":
            raise Refusal("GLOB_CHARACTER_CLASS_UNSUPPORTED")
        if kind == "dangling":
            raise Refusal("GLOB_DANGLING_ESCAPE")
        out.append(_PART.get(kind) or re.escape(m.group()[1:] if kind == "escaped" else m.group()))
        if kind == "rest":
            break
    return "".join(out)


def glob_to_regex(pattern: str, root: str) -> str:
    """An anchored expression for paths under ``root`` that match ``pattern``;
    a pattern without a slash matches at any depth."""
    if not pattern or pattern[0] in "!/" or "\0" in pattern + root:
        raise Refusal("GLOB_PATTERN_DIALECT_UNSUPPORTED")
    return f"(?s)^{re.escape(root.rstrip('/') + '/')}(?:{'|'.join(map(_translate, expand(pattern)))})$"
