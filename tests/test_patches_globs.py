import re

import pytest

from quern.plans.codes import Refusal
from quern.plans.globs import expand, glob_to_regex
from quern.plans.patches import apply_hunks, read_patch


def patch(*lines):
    return "\n".join(["*** Begin Patch", *lines, "*** End Patch"])


def test_reads_all_sections():
    text = patch("*** Add File: a", "+x", "+", "*** Update File: b", "*** Move to: c", "@@ def f", " k", "-o", "+n", "", "*** End of File", "*** Delete File: d")
    add, update, delete = read_patch(text)
    assert (add.kind, add.content) == ("add", "x\n\n")
    assert (update.move_to, update.hunks[0].hint, update.hunks[0].at_eof) == ("c", "def f", True)
    assert update.hunks[0].side("-") == ["k", "o", ""] and update.hunks[0].side("+") == ["k", "n", ""]
    assert delete.kind == "delete"


def test_line_number_header_is_no_hint():
    assert read_patch(patch("*** Update File: b", "@@ -1,2 +1,2 @@ def", "-o", "+n"))[0].hunks[0].hint == ""


@pytest.mark.parametrize(("lines", "code"), [
    (["*** Update File: a"], "EMPTY_UPDATE"), (["*** Update File: a", "@@", "+x"], "CONTEXTLESS_UPDATE"), (["*** Add File: a", "-x"], "ADD_REQUIRES_PLUS_LINES"),
    (["*** Delete File: a", "+x"], "DELETE_WITH_CONTENT"), (["*** Move to: b"], "INVALID_MOVE"), (["*** End of File"], "EOF_WITHOUT_UPDATE_HUNK"), ([], "EMPTY_PATCH"),
    (["*** Add File: a", "@@"], "HUNK_WITHOUT_UPDATE"), (["*** Begin Patch"], "NESTED_PATCH_ENVELOPE"), (["*** Update File: a", "-x", "*** End of File", "-y"], "CONTENT_AFTER_EOF"),
    (["text"], "UNSUPPORTED_PATCH_LINE"), (["*** Add File: "], "PATCH_PATH_INVALID"), (["*** Update File: a", "*** Move to: ", "-x"], "INVALID_MOVE_PATH"), (["*** End Patch", "between", "*** Begin Patch"], "TEXT_OUTSIDE_PATCH"),
])
def test_refusals(lines, code):
    with pytest.raises(Refusal, match=code):
        read_patch(patch(*lines))


@pytest.mark.parametrize(("text", "code"), [(3, "PATCH_NOT_TEXT"), ("x", "PATCH_ENVELOPE_REQUIRED"), ("", "PATCH_ENVELOPE_REQUIRED")])
def test_envelope(text, code):
    with pytest.raises(Refusal, match=code):
        read_patch(text)


def hunks(*lines):
    return read_patch(patch("*** Update File: a", *lines))[0].hunks


def test_apply():
    before = "a\nb\nc\nb\n"
    assert apply_hunks(before, hunks("@@ c", "-b", "+B")) == "a\nb\nc\nB\n"
    assert apply_hunks(before, hunks("@@", "-b", "+B", "*** End of File")) == "a\nb\nc\nB\n"
    assert apply_hunks("a\n", hunks("@@", "-a")) == ""
    two = hunks("@@", "-a", "+A", "@@", "-c", "+C")
    assert apply_hunks(before, two) == "A\nb\nC\nb\n"
    for lines, code in ((["@@", "-b", "+B"], "CONTEXT_NOT_UNIQUE"), (["@@ b", "-c"], "HINT_NOT_UNIQUE"), (["@@", "-c", "@@", "-a"], "CONTEXT_NOT_UNIQUE")):
        with pytest.raises(Refusal, match=code):
            apply_hunks(before, hunks(*lines))
    with pytest.raises(Refusal, match="NEWLINE"):
        apply_hunks("a\r\n", two)


FILES = ["/r/a.py", "/r/b/c.py", "/r/b/d/e.txt", "/r/.hidden", "/q/a.py"]


@pytest.mark.parametrize(("pattern", "want"), [
    ("*.py", ["/r/a.py", "/r/b/c.py"]), ("b/*.py", ["/r/b/c.py"]), ("b/**", ["/r/b/c.py", "/r/b/d/e.txt"]), ("**/*.{py,txt}", ["/r/a.py", "/r/b/c.py", "/r/b/d/e.txt"]), ("?.py", ["/r/a.py", "/r/b/c.py"]), ("b/**/e.txt", ["/r/b/d/e.txt"]), ("\\*.py", []),
])
def test_globs(pattern, want):
    assert [f for f in FILES if re.match(glob_to_regex(pattern, "/r"), f)] == want


@pytest.mark.parametrize(("pattern", "code"), [("", "DIALECT"), ("/a", "DIALECT"), ("!a", "DIALECT"), ("[a]", "CLASS"), ("{a}", "BRACE"), ("{a,{b,c}}", "BRACE"), ("{a", "BRACE"), ("a\\", "ESCAPE"), ("{a,b}" * 7, "LIMIT")])
def test_glob_refusals(pattern, code):
    with pytest.raises(Refusal, match=code):
        glob_to_regex(pattern, "/r")


def test_expand():
    assert expand("{a,b}{c,d}") == ["ac", "ad", "bc", "bd"]
