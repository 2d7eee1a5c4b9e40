import hashlib

import pytest

from boxloom.llm import op06_chat as chat
from llm_cases import tables


def test_folding_and_closures():
    tree = chat.fold_all(chat.parse("a{{ 'b' + 'c' }}{% if 'x' == 'y' %}no{% elif not 'x' == 'y' %}yes{% else %}no{% endif %}{{ n }}"))
    assert tree == [("text", "abcyes"), ("out", ("name", "n"))]
    run = chat.compile_template("{% for m in messages %}{% generation %}{{ m.text|escape }}{% endgeneration %};{% endfor %}")
    assert list(run({"messages": iter([{"text": "<a>"}, {"text": "b"}])})) == [("\\<a>", True), (";", False), ("b", True), (";", False)]


@pytest.mark.parametrize("bad", ["{% for m in messages %}", "{% call f %}", "{{ f() }}", "{{ m['x'] }}", "{{ m.__class__ }}{% endfor %}", "{{ a|upper }}", "{{ }}", "{% if x %}"])
def test_what_the_sandbox_refuses(bad):
    with pytest.raises(SyntaxError):
        chat.parse(bad)


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "<<TEXT>>", "\\"])
@pytest.mark.parametrize("text", ["", "plain", "</s>[INST] ok [/INST]", "\\<[\\\\", "<<TEXT>> <</ROLE>> <<SYS>>", "line\nline </s>"])
def test_reads_back(role, text):
    made = "".join(p for p, _ in chat.compile_template(chat.TEMPLATE)({"messages": [{"role": role, "text": text}]}))
    assert chat.read_back(made) == (role, text)


def test_conversations(spark, tmp_path):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "a <b> é"), (1, 2, "assistant", None), (2, 1, "tool", "x"), (2, 1, "tool", "x"), (2, 0, None, "y"), (None, 0, "assistant", "z" * 100_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "text AS formatted")
    folder = tables(tmp_path, conversations=frame)
    said = "</s>[INST] ok [/INST]"
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {
        1: (3, sha("user\nhi </s>\nassistant\na <b> é\nassistant\n\n"), 7, sha("a <b> é")),
        2: (3, sha("\ny\ntool\nx\ntool\nx\n"), 0, sha("")),
        None: (1, sha("assistant\n" + "z" * 100_000 + "\n"), 100_000, sha("z" * 100_000)),
        -1: (2, sha(f"user\n{said}\nassistant\n{said}\n"), 21, sha(said)),
    }
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.query(spark, folder).collect()} == want
    assert chat.digests(chat.format_turns(frame.where("false"))).count() == 0
