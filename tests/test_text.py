"""Tokens, escapes, counting, stemming and the analyzer on hand-made text."""

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import text
from broadsheet.functions.porter import stem
from broadsheet.operators import analyzer


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_tokens_keep_separators_and_split_chinese_runs(spark):
    got = values(spark, ["Hello, wörld", "中文新闻A x", "我", "", None], text.tokens("text"))
    assert got == [["Hello", ",", " ", "wörld"], ["中文", "文新", "新闻", "A", " ", "x"], ["我"], [],
                   None]


def test_keyword_tokens_equal_filtered_tokens(spark):
    texts = ["The cat and THE dog", "中文新闻A the x 我", "a b c", "It\nis x9 ok"]
    fast = values(spark, texts, text.keyword_tokens("text"))
    slow = values(spark, texts, F.filter(text.tokens("text"), lambda t: text.is_keyword(t)))
    assert fast == slow == [["cat", "dog"], ["中文", "文新", "新闻"], [], ["x9", "ok"]]


def test_spans_point_back_into_the_text(spark):
    texts = ["Hello, wörld 中文新闻A x 我", "", "x", "A中文B新", "  ab  cd  "]
    for original, spans in zip(texts, values(spark, texts, text.token_spans("text"))):
        for s in spans:
            assert original[s["startpos"]:s["endpos"]] == s["term"]
    first = values(spark, texts[:1], text.token_spans("text"))[0]
    assert [s["term"] for s in first] == ["Hello", "wörld", "中文", "文新", "新闻", "我"]


def test_count_values(spark):
    got = values(spark, ["b a b", "", "x"], text.count_values(F.split("text", " ")))
    assert [[tuple(r) for r in rows] for rows in got] == [[("a", 1), ("b", 2)], [("", 1)],
                                                          [("x", 1)]]


@pytest.mark.parametrize("stored, expected", [
    (r"\xE9\xA6\x99\xE6\xB8\xAF", "香港"),
    (r"\xE9\xA6\x99 (a) it's", "香 (a) it's"),
    ("plain 'quoted' text", "plain 'quoted' text"),
    (r"\xFF\xFE", "invalid"),
    (r"bad \xZ1", "invalid"),
    (r"a\b\x41", r"a\bA"),
    ("", ""),
])
def test_unescape(spark, stored, expected):
    assert values(spark, [stored], text.unescape("text")) == [expected]


PORTER = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre
plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size
hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi
sky sky relational relat conditional condit rational ration valenci valenc digitizer digit
radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam
predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
formative form formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin adjustable adjust defensible defens
irritant irrit replacement replac adjustment adjust dependent depend adoption adopt communism
commun activate activ effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll yes ye by by""".split()


def test_stems_of_the_published_examples(spark):
    words, stems = PORTER[::2], PORTER[1::2]
    assert values(spark, words, stem(F.col("text"))) == stems


def test_analyzer_chain(spark):
    docs = spark.createDataFrame([(1, "The Runners are running, x 和 新闻")], "id int, text string")
    rows = analyzer.analyze(docs, ["id"]).orderBy("startpos").collect()
    assert [(r.term, r.startpos, r.endpos) for r in rows] == [
        ("runner", 4, 11), ("run", 16, 23), ("新闻", 29, 31)]
    longer = analyzer.analyze(docs, ["id"], stop_words=("are",), min_size=4, stem=False).collect()
    assert sorted(r.term for r in longer) == ["runners", "running"]
