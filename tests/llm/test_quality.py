import zlib

from broadsheet.llm import quality
from broadsheet.llm.queries import QUERIES

#: Has about 800 labelled documents that are held out.
FOLDER = "/root/testdata/sf0.1"
TREE = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5
  If (feature 0 <= 3.5)
   If (feature 1 <= 1.0E-4)
    Predict: 0.0
   Else (feature 1 > 1.0E-4)
    Predict: 1.0
  Else (feature 0 > 3.5)
   Predict: 1.0
"""


def conditions(rule):
    return {(c.statistic, c.above, c.bound) for c in rule}


def test_paths_of_a_tree():
    a, b = quality.NAMES[:2]
    found = {frozenset(conditions(r)) for r in quality.paths(TREE)}
    assert found == {
        frozenset({(a, False, 3.5)}), frozenset({(a, True, 3.5)}),
        frozenset({(a, False, 3.5), (b, False, 1e-4)}), frozenset({(a, False, 3.5), (b, True, 1e-4)}),
    }


def test_only_the_tightest_condition_stays():
    tree = "x\n  If (feature 0 <= 9.0)\n   If (feature 0 <= 3.0)\n    Predict: 0.0\n"
    assert {frozenset(conditions(r)) for r in quality.paths(tree)} == {
        frozenset({(quality.NAMES[0], False, 9.0)}), frozenset({(quality.NAMES[0], False, 3.0)})}


def test_held_out_accuracy(spark):
    scored = QUERIES["op9_quality"](spark, FOLDER)
    rows = scored.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.98 * len(held)


def test_edge_cases(spark, make_docs):
    docs = make_docs((1, None), (2, ""), (None, "a b c"), (3, "x " * 200_000), (3, "x " * 200_000))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(docs, none).constant == 0.5
    one = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert quality.fit(docs, one).constant == 1.0
    kept = quality.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 5
    both = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, quality int")
    scores = quality.score(docs, quality.fit(docs, both)).collect()
    assert len(scores) == 5 and all(0 <= r.score <= 1 for r in scores)
    assert quality.keep_good(docs.limit(0), none).count() == 0


def test_no_python_in_the_scores(spark, make_docs):
    rule = frozenset({quality.Condition("words", True, 2.0)})
    plan = quality.score(make_docs((1, "a b c")), quality.RuleModel(-1.0, [(rule, 2.0)]))
    assert round(plan.first().score, 4) == 0.7311
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
