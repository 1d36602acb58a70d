"""Shell text and its column form; commands run only here, in a temp directory."""

import random
import subprocess

import pytest
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.plans import shell
from quern.plans.codes import Refusal

BODIES = ["", "x", "no newline", "a\n", "ünïcode ☃\r\nline\n", "$(rm -rf x) `y` \"q\" 'z'\n", "EOF\nTB_CONTENT_0\n", "a\n\n\n"]


@pytest.mark.parametrize("body", BODIES)
def test_write_is_exact(tmp_path, body):
    path = str(tmp_path / "a b'c.txt")
    subprocess.run(["bash", "-c", shell.write_file(path, body)], check=True)
    assert open(path, newline="").read() == body


def test_replace_everywhere_is_literal(tmp_path):
    rng = random.Random(7)
    letters = "ab.*[]^$|\\/&'\"\n\t"
    for n in range(40):
        text, old, new = ("".join(rng.choice(letters) for _ in range(k)) for k in (rng.randrange(1, 20), rng.randrange(1, 3), rng.randrange(4)))
        path = tmp_path / f"f{n}"
        path.write_bytes(text.encode())
        done = subprocess.run(["bash", "-c", shell.replace_everywhere(str(path), old, new)])
        assert path.read_bytes().decode() == text.replace(old, new)
        assert (done.returncode == 0) == (old in text)


def test_subshell_and_login_shell(tmp_path):
    assert subprocess.run(["bash", "-c", shell.subshell("# only a comment")]).returncode == 0
    assert subprocess.run(["bash", "-c", shell.subshell("exit 3")]).returncode == 3
    out = subprocess.run(["bash", "-c", shell.login_shell("echo \"$0\" 'x'; cat\n# TB_SCRIPT\nTB_SCRIPT=1")], capture_output=True, text=True, input="in")
    assert "x" in out.stdout and "in" in out.stdout


def test_delete(tmp_path):
    (tmp_path / "f").write_text("x")
    subprocess.run(["bash", "-c", shell.delete_file(str(tmp_path / "f"))], check=True)
    assert not (tmp_path / "f").exists()
    assert subprocess.run(["bash", "-c", shell.delete_file(str(tmp_path))]).returncode != 0


@pytest.mark.parametrize(("path", "cwd", "want"), [("/a/../b", None, "/a/../b"), ("x", "/r", "/r/x"), ("x", "/r/", "/r/x")])
def test_absolute(path, cwd, want):
    assert shell.absolute(path, cwd) == want


@pytest.mark.parametrize(("path", "cwd"), [("x", None), ("x", "rel"), ("", "/r"), ("a\0", "/r"), (None, "/r")])
def test_absolute_refuses(path, cwd):
    with pytest.raises(Refusal):
        shell.absolute(path, cwd)


def test_columns_agree(spark):
    rng = random.Random(1)
    letters = list("ab'\"\\&|.[]*^$/#\n\r\t \u0085\u2028\u2029é🙂:TB_")
    cases = ["".join(rng.choice(letters) for _ in range(rng.randrange(14))) for _ in range(200)] + ["TB_SCRIPT\nx", "# a\n\n", "x\n", "\n".join("TB_SCRIPT" + "_END" * k for k in range(9)), "TB_SCRIPT\nTB_SCRIPT_END_END"]
    rows = spark.createDataFrame([(c, rng.choice(cases)) for c in cases], "a string, b string")
    a, b = F.col("a"), F.col("b")
    exact = X.replaces_exactly(F.lit("sweagent"), F.concat(b, a), a, b)
    made = rows.select(a, b, X.shell_word(a), X.write_command(b, a), X.subshell(a), X.login_shell(a), X.sed_text(a), X.sed_text(a, True), X.replace_everywhere(F.lit("/p q"), a, b), X.lines(a), exact, X.delete_command(a)).collect()
    for r in made:
        x, y = r[0], r[1]
        want = [shell.word(x), shell.write_file(y, x), shell.subshell(x), shell.login_shell(x), shell.sed_text(x), shell.sed_text(x, True), shell.replace_everywhere("/p q", x, y) if x else None, x.splitlines(), shell.replaces_exactly(False, y + x, x, y), shell.delete_file(x)]
        got = list(r[2:])
        if x == "":
            want[8], got[8] = False, bool(got[8])
        assert got == want, (x, y)


def test_content_columns(spark):
    from quern.core.jsonio import content_text
    from quern.plans.dialogue import message_text

    contents = ["plain", None, [{"type": "text", "text": "a"}, {"type": "thinking", "thinking": "t"}, {"type": "text", "text": "b"}], [], ["odd"], 3, {"x": 1}, "[1]", "🙂"]
    import json

    messages = [{"role": "user", "content": c} for c in contents] + [{"role": "user"}, {"role": "assistant", "content": "c", "reasoning_content": "r"}, {"role": "assistant", "content": "c", "reasoning_content": 5}, {"role": "assistant", "content": [{"type": "image"}]}]
    rows = spark.createDataFrame([(i, json.dumps(m)) for i, m in enumerate(messages)], "i int, j string").withColumn("v", F.parse_json("j"))
    got = {r[0]: r[1:] for r in rows.select("i", X.content_text(F.col("v")), X.message_text(F.col("v")), X.message_text_error(F.col("v"))).collect()}
    for i, m in enumerate(messages):
        assert got[i][0] == content_text(m.get("content"))
        try:
            assert (got[i][1], got[i][2]) == (message_text(m), None)
        except Refusal as e:
            assert got[i][1] is None and str(e).startswith(got[i][2].split(":")[0])
