"""The patch envelope: reading it as a line grammar and applying it exactly.

    patch  := "*** Begin Patch" section* "*** End Patch"        (once or more)
    section:= "*** Add|Update|Delete File: " path  move?  hunk*
    move   := "*** Move to: " path                              (update only)
    hunk   := ("@@" | "@@ " hint)?  line+  "*** End of File"?
    line   := one of " ", "+", "-" and text; an empty line of an update is " "
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from quern.plans.codes import Refusal

_SECTION = re.compile(r"\*\*\* (Add|Update|Delete) File: (.*)", re.S)
_LINE_NUMBERS = re.compile(r"[-+]?\d+(?:,\d+)?(?:\s+\+\d+(?:,\d+)?)?\s*@@.*")


@dataclass
class Hunk:
    hint: str = ""
    numbered: bool = False
    at_eof: bool = False
    lines: list[tuple[str, str]] = field(default_factory=list)

    def side(self, sign: str) -> list[str]:
        """Lines before (sign "-") or after (sign "+") the change."""
        return [text for tag, text in self.lines if tag in (" ", sign)]


@dataclass
class Change:
    kind: str
    path: str
    group: int
    move_to: str | None = None
    hunks: list[Hunk] = field(default_factory=list)

    @property
    def content(self) -> str:
        """The text of an added file."""
        return "".join(text + "\n" for h in self.hunks for _, text in h.lines)

    def as_dict(self) -> dict:
        out: dict = {"kind": self.kind, "path": self.path, "group": self.group, "hunks": [{"context_hint": h.hint, "at_eof": h.at_eof, "old_lines": h.side("-"), "new_lines": h.side("+")} for h in self.hunks]}
        if self.move_to is not None:
            out["move_to"] = self.move_to
        if self.kind == "add":
            out["content"] = self.content
        return out


class _Reader:
    """One pass over the lines; ``change`` and ``hunk`` are what is open."""

    def __init__(self) -> None:
        self.changes: list[Change] = []
        self.change: Change | None = None
        self.hunk: Hunk | None = None
        self.inside, self.group = False, -1

    @property
    def updating(self) -> bool:
        return self.change is not None and self.change.kind == "update"

    def begin(self) -> None:
        if self.inside:
            raise Refusal("NESTED_PATCH_ENVELOPE")
        self.inside, self.change, self.hunk = True, None, None
        self.group += 1

    def end(self) -> None:
        if not self.inside:
            raise Refusal("UNMATCHED_PATCH_END")
        self.inside, self.change, self.hunk = False, None, None

    def section(self, kind: str, path: str) -> None:
        if not path or "\0" in path:
            raise Refusal("PATCH_PATH_INVALID")
        self.change, self.hunk = Change(kind.lower(), path, self.group), None
        self.changes.append(self.change)

    def move(self, path: str) -> None:
        if not self.updating or self.change.move_to is not None:
            raise Refusal("INVALID_MOVE")
        if not path or "\0" in path:
            raise Refusal("INVALID_MOVE_PATH")
        self.change.move_to = path

    def eof(self) -> None:
        if self.hunk is None or not self.updating:
            raise Refusal("EOF_WITHOUT_UPDATE_HUNK")
        self.hunk.at_eof = True

    def open_hunk(self, header: str) -> None:
        hint = header.strip()
        numbered = bool(_LINE_NUMBERS.fullmatch(hint))
        self.hunk = Hunk("" if numbered else hint, numbered)
        self.change.hunks.append(self.hunk)

    def header(self, text: str) -> None:
        if not self.updating:
            raise Refusal("HUNK_WITHOUT_UPDATE")
        self.open_hunk(text)

    def content(self, tag: str, text: str) -> None:
        if self.change.kind == "delete":
            raise Refusal("DELETE_WITH_CONTENT")
        if self.change.kind == "add" and tag != "+":
            raise Refusal("ADD_REQUIRES_PLUS_LINES")
        if self.hunk is None:
            self.open_hunk("")
        if self.hunk.at_eof:
            raise Refusal("CONTENT_AFTER_EOF")
        self.hunk.lines.append((tag, text))

    def feed(self, line: str) -> None:
        if line == "*** Begin Patch":
            return self.begin()
        if line == "*** End Patch":
            return self.end()
        if not self.inside:
            if line.strip():
                raise Refusal("TEXT_OUTSIDE_PATCH")
            return None
        if line == "":
            if self.hunk is not None and self.hunk.at_eof:
                return None
            if self.updating:
                line = " "
        if m := _SECTION.fullmatch(line):
            return self.section(*m.groups())
        if line.startswith("*** Move to: "):
            return self.move(line.removeprefix("*** Move to: "))
        if line == "*** End of File":
            return self.eof()
        if line == "@@" or line.startswith("@@ "):
            return self.header(line[2:])
        if self.change is not None and line[:1] in (" ", "+", "-") and line:
            return self.content(line[0], line[1:])
        raise Refusal("UNSUPPORTED_PATCH_LINE:" + line[:60])


def read_patch(text: object) -> list[Change]:
    """The changes of a patch; a Refusal with its code if it has no meaning."""
    if not isinstance(text, str):
        raise Refusal("PATCH_NOT_TEXT")
    lines = text.splitlines()
    if not lines or (lines[0], lines[-1]) != ("*** Begin Patch", "*** End Patch"):
        raise Refusal("PATCH_ENVELOPE_REQUIRED")
    reader = _Reader()
    for line in lines:
        reader.feed(line)
    if not reader.changes:
        raise Refusal("EMPTY_PATCH")
    if reader.inside:
        raise Refusal("UNTERMINATED_PATCH")
    for change in reader.changes:
        if change.kind == "update":
            if not change.hunks:
                raise Refusal("EMPTY_UPDATE")
            if not all(h.side("-") for h in change.hunks):
                raise Refusal("CONTEXTLESS_UPDATE")
    return reader.changes


def apply_hunks(before: str, hunks: list[Hunk]) -> str:
    """``before`` with every hunk applied where its old lines stand, which must
    be one place after the place of the hunk before."""
    if "\r" in before:
        raise Refusal("PATCH_NEWLINE_POLICY_UNVERIFIED")
    done: list[str] = []
    rest = before.splitlines()
    for hunk in hunks:
        if hunk.hint:
            if rest.count(hunk.hint) != 1:
                raise Refusal("PATCH_HINT_NOT_UNIQUE")
            at = rest.index(hunk.hint) + 1
            done, rest = done + rest[:at], rest[at:]
        old = hunk.side("-")
        last = len(rest) - len(old)
        places = [k for k in ([last] if hunk.at_eof else range(last + 1)) if k >= 0 and rest[k : k + len(old)] == old]
        if len(places) != 1:
            raise Refusal("PATCH_CONTEXT_NOT_UNIQUE")
        at = places[0]
        done, rest = done + rest[:at] + hunk.side("+"), rest[at + len(old) :]
    lines = done + rest
    return "".join(line + "\n" for line in lines)
