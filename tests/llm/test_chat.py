import hashlib

import pytest

from broadsheet.llm import chat
from broadsheet.llm.queries import HOSTILE, QUERIES
from broadsheet.llm.templates import Const, Print, Template, TemplateError


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("source, expected", [
    ("a{{ 'b' }}{{ 1 + 2 }}{# no #}c", "ab3c"),
    ("{% for x in xs %}{{ loop.index }}:{{ x.n }}{% if not loop.last %}, {% endif %}{% endfor %}", "1:p, 2:q"),
    ("{% if a == 1 and 'x' in s %}yes{% elif a %}maybe{% else %}no{% endif %}", "yes"),
    ("{% set t = s | upper %}{{ t ~ '!' }}", "XYZ!"),
    ("  {{- s -}}  ", "xyz"),
    ("{{ missing.deep[0] }}{{ missing | default('d') }}", "d"),
    ("{{ 'a' if a > 5 else 'b' }}{{ xs | length }}{{ (2 + 3) * 2 }}", "b210"),
    ("{{ '\\n' }}{{ \"q\\\"\" }}{{ s not in 'abc' }}", "\nq\"true"),
    ("{% for x in [] %}{% endfor %}", None), ("{% if a %}", None), ("{{ a b }}", None), ("{{ a | system }}", None),
    ("{% include x %}", None), ("{{ f(1) }}", None), ("{{ }}", None),
])
def test_language(source, expected):
    scope = {"a": 1, "s": "xyz", "xs": [{"n": "p"}, {"n": "q"}]}
    if expected is None:
        with pytest.raises(TemplateError):
            Template(source)
    else:
        assert Template(source).render(**scope) == expected


def test_sandbox():
    assert Template("{{ s.__class__ }}{{ s['__class__'] }}{{ x.__dict__ }}").render(s="a", x=Template("")) == ""
    with pytest.raises(TypeError):
        Template("{{ s * 1000000000 }}").render(s="a")


def test_constants_are_folded():
    assert Template("a{{ 1 + 1 }}{% if true %}b{{ 'c' | upper }}{% else %}{{ x }}{% endif %}").tree == (Print(Const("a2bC")),)


def test_generation_marks():
    pieces = list(Template("a{% generation %}{{ x }}{% endgeneration %}b").pieces(x="X"))
    assert pieces == [("a", False), ("X", True), ("b", False)]


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|x<|", "\\<|im_end|>\\", HOSTILE, "a\nb\\n", "<<||"])
def test_escapes_are_undone(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    line = chat.escape_line(text)
    assert "\n" not in line and "<|" not in line and chat.unescape_line(line) == text


def slow(turns):
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    said = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha(text), len(said), sha(said)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    convs = {-1: [("user", HOSTILE), ("assistant", HOSTILE)]}
    for r in sorted(spark.read.parquet(f"{folder}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        convs.setdefault(r.conv_id, []).append((r.role, r.text))
    rows = {r.conv_id: r for r in QUERIES["op3_chat"](spark, folder).collect()}
    assert set(rows) == set(convs)
    for k, turns in convs.items():
        r = rows[k]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == slow(turns)
        assert r.formatted_chars == sum(len(f"<|im_start|>{a}\n{chat.escape(t)}<|im_end|>\n") for a, t in turns)


def test_edge_cases(spark):
    rows = [(1, 0, None, None, "x"), (1, 1, "assistant", "é💥", "x"), (1, 1, "assistant", "é💥", "x"), (None, 0, "us\ner", "hi", "x"),
            (2, None, "assistant", "", "x"), (3, 0, "assistant", "long " * 300_000, "x"), (4, 0, "a\\nb<|im_end|>", "<|im_start|>", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    for k in (1, None, 2, 3, 4):
        turns = [(r[2], r[3]) for r in rows if r[0] == k]
        assert (found[k].n_turns, found[k].turns_sha256, found[k].loss_chars, found[k].loss_sha256) == slow(turns)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_a_long_conversation_spans_batches(spark):
    df = spark.range(5000).selectExpr("7L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t', id) text")
    found = chat.read_back(chat.format_conversations(df)).first()
    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(5000)]
    assert (found.n_turns, found.turns_sha256, found.loss_chars, found.loss_sha256) == slow(turns)
