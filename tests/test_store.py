"""Cells, keyed tables and text files."""

import glob

from pyspark.sql import functions as F

from broadsheet.operators import keywords, lookup, store
from broadsheet.sources import articles, files

CELLS = [
    ("row1", "f1", "a", 1450598363113, "Put", "value1"),
    ("row1", "f1", "b", 1450598369239, "Put", "value2"),
    ("row2", "f1", "", 1450598376945, "Put", "value3"),
    ("row3", "f1", "", 1450598382736, "Put", "value4"),
]
SCHEMA = ("row string, columnFamily string, qualifier string, timestamp bigint, type string, "
          "value string")


def cells_of(df):
    return sorted(tuple(r) for r in df.select(
        "row", "columnFamily", "qualifier", "timestamp", "type", "value").collect())


def test_cells_json_round_trip(spark):
    wide = spark.createDataFrame(
        [("row1", 'va"lue\n1', "value2"), ("row2", None, "value3")], "row string, a string, b string")
    blobs = articles.rows_to_json(wide, "row", ("a", "b"), "f1", F.lit(1450598363113))
    assert sorted(r.blob.count("\n") for r in blobs.collect()) == [0, 1]
    assert cells_of(articles.cells_from_json(blobs)) == [
        ("row1", "f1", "a", 1450598363113, "Put", 'va"lue\n1'),
        ("row1", "f1", "b", 1450598363113, "Put", "value2"),
        ("row2", "f1", "b", 1450598363113, "Put", "value3")]


def test_cells_of_a_scan(spark):
    lines = spark.createDataFrame(CELLS, SCHEMA).select("row", F.to_json(F.struct(
        "row", "columnFamily", "qualifier", F.col("timestamp").cast("string").alias("timestamp"),
        "type", "value")).alias("blob"))
    blobs = lines.groupBy("row").agg(F.array_join(F.collect_list("blob"), "\n").alias("blob"))
    assert cells_of(articles.cells_from_json(blobs)) == CELLS


def test_stored_time_is_text_in_json(spark):
    blob = '{"qualifier":"a","timestamp":"1450598363113","value":"v","columnFamily":"f1",' \
           '"type":"Put","row":"row1"}'
    one = spark.createDataFrame([("row1", blob)], "row string, blob string")
    assert cells_of(articles.cells_from_json(one)) == [
        ("row1", "f1", "a", 1450598363113, "Put", "v")]


def test_wide_rows_and_cells(spark):
    wide = spark.createDataFrame([("u1", "t1", "c1"), ("u2", "t2", "c2")],
                                 "url string, title string, content string")
    cells = articles.to_cells(wide, timestamp=F.lit(5))
    assert cells.count() == 4
    newer = cells.filter("row = 'u1' and qualifier = 'title'").withColumn(
        "value", F.lit("new")).withColumn("timestamp", F.lit(6).cast("bigint"))
    back = articles.from_cells(cells.unionByName(newer)).orderBy("url").collect()
    assert [tuple(r) for r in back] == [("u1", "new", "c1"), ("u2", "t2", "c2")]


def test_put_replaces_and_repeating_it_changes_nothing(spark):
    base = spark.createDataFrame(CELLS, SCHEMA)
    put = store.put_records(spark, [("row1", "f1", "a", "new"), ("row4", "f1", "q1", "value4")],
                            1450598400000)
    key, order = ["row", "columnFamily", "qualifier"], ["timestamp"]
    once = store.upsert_latest(base, put, key, order)
    values = {(r.row, r.qualifier): r.value for r in once.collect()}
    assert values[("row1", "a")] == "new" and values[("row4", "q1")] == "value4"
    assert len(values) == 5
    assert cells_of(store.upsert_latest(once, put, key, order)) == cells_of(once)


def test_tied_writes_and_both_ways_to_fetch(spark, monkeypatch):
    schema = "key string, t int, v string, w array<string>"
    base = spark.createDataFrame([("a", 1, "old", None), ("a", 1, "later", ["x"]), (None, 1, "n", None), ("b", None, "z", None),
                                  ("c", 5, "kept", [])], schema)
    updates = spark.createDataFrame([("a", 1, "latest", None), (None, 1, None, ["y"]), ("b", 0, "b", None), ("c", 4, "older", None),
                                     ("d", 1, "new", None)] + [("hot", 7, f"h{k}", None) for k in range(3000)], schema)
    expected = {"a": "latest", None: None, "b": "b", "c": "kept", "d": "new", "hot": "h2999"}
    for rows in (store.BROADCAST_ROWS, 0):
        monkeypatch.setattr(store, "BROADCAST_ROWS", rows)
        merged = store.upsert_latest(base, updates, ["key"], ["t"])
        assert merged.columns == base.columns
        found = merged.collect()
        assert len(found) == 6 and {r.key: r.v for r in found} == expected
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Sort" not in plan
        assert ("BroadcastHashJoin" if rows else "ShuffledHashJoin") in plan
    empty = base.limit(0)
    assert store.upsert_latest(empty, empty, ["key"], ["t"]).isEmpty()


def test_versions_prefix_and_keys(spark):
    rows = spark.createDataFrame([("k", t, t) for t in range(5)] + [("other", 9, 9)],
                                 "key string, t int, v int")
    kept = store.keep_versions(rows, ["key"], ["t"]).filter("key = 'k'")
    assert sorted(r.t for r in kept.collect()) == [2, 3, 4]
    keys = spark.createDataFrame([("k",), ("absent",)], "key string")
    assert {r.key for r in store.get_rows(rows, keys, "key").collect()} == {"k"}
    assert {r.key for r in store.delete_rows(rows, keys, "key").collect()} == {"other"}
    assert store.scan_prefix(rows, "key", "ot").count() == 1


ARTICLE = ("标题", "http://x.cn/1.shtml", "2013-01-04 23:16:00", "第一段\n\n　　第二段\n")


def test_article_text_round_trip(spark, tmp_path):
    two = [ARTICLE, ("t2", "u2", "2013-01-05 00:00:00", "one line")]
    df = spark.createDataFrame(two, "title string, url string, time string, content string")
    path = str(tmp_path / "articles")
    files.write_article_text(df, path)
    assert sorted(p[-8:] for p in glob.glob(path + "/day=*")) == ["20130104", "20130105"]
    back = files.read_article_text(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(two)


def test_article_text_one_per_file(spark, tmp_path):
    (tmp_path / "site-0.txt").write_text("\n".join(ARTICLE), encoding="utf-8")
    back = files.read_article_text(spark, str(tmp_path / "site-0.txt"), one_per_file=True)
    assert [tuple(r) for r in back.collect()] == [ARTICLE]


def test_manifest_file(spark, tmp_path):
    entries = spark.createDataFrame(
        [("ZXW", "late", "d/ZXW-1.txt", "2015-11-02 09:00:00", "b"),
         ("163", "early", "d/163-0.txt", "2015-11-02 08:00:00", "a")],
        "site string, title string, path string, time string, url string")
    path = str(tmp_path / "manifest")
    files.write_manifest(entries, path, "2015-11-03 00:00:00")
    lines = [line for part in sorted(glob.glob(path + "/part-*"))
             for line in open(part, encoding="utf-8").read().splitlines()]
    assert lines == ["===========NEWS_LIST2015-11-03 00:00:00============",
                     "163###early###d/163-0.txt###1446451200.0",
                     "ZXW###late###d/ZXW-1.txt###1446454800.0"]


def test_idf_dictionary(spark, tmp_path):
    (tmp_path / "idf.txt").write_text("a 3.0\nb 1.5\na 2.0\nc 9\nd 4.5\n")
    idf = files.read_idf(spark, str(tmp_path / "idf.txt"))
    assert {r.term: r.idf for r in idf.collect()} == {"a": 2.0, "b": 1.5, "c": 9.0, "d": 4.5}
    assert keywords.median_idf(idf).first()[0] == 4.5
    assert keywords.median_idf(idf.filter("term != 'c'")).first()[0] == 2.0


def test_capitalised_stop_word_never_matches(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("dog\nCat\n")
    listed = files.read_stop_words(spark, str(tmp_path / "stop.txt"))
    docs = spark.createDataFrame([(1, "Cat cat Dog dog bird bird")], "doc int, text string")
    terms = keywords.term_frequencies(docs, ["doc"])
    left = keywords.drop_stop_terms(terms, ["doc"], listed).orderBy("term").collect()
    assert [(r.term, r.freq, r.total) for r in left] == [
        ("Cat", 1, 4), ("bird", 2, 4), ("cat", 1, 4)]


def test_article_text_keeps_the_layout(spark, tmp_path):
    made = spark.createDataFrame(
        [("u1", None, "2015-11-03 00:00:00", "a\nb"), ("u2", "x\ny", "2015-11-03 00:00:00", "c\x1ed")],
        "url string, title string, time string, content string",
    )
    path = str(tmp_path / "layout")
    files.write_article_text(made, path)
    back = {r.url: (r.title, r.time, r.content) for r in files.read_article_text(spark, path).collect()}
    assert back == {"u1": ("", "2015-11-03 00:00:00", "a\nb"), "u2": ("x y", "2015-11-03 00:00:00", "c d")}


def test_manifest_titles_hold_no_separator(spark):
    made = spark.createDataFrame(
        [("s", "#a###b\nc#", "p", "2015-11-03 00:00:00", "u"), ("s", None, "p", "2015-11-03 00:00:01", "u")],
        "site string, title string, path string, time string, url string",
    )
    lines = [r.line.split("###") for r in files.manifest_lines(made).collect()]
    assert [x[:3] for x in lines] == [["s", "a#b c", "p"], ["s", "", "p"]] and all(len(x) == 4 for x in lines)


def test_search_shuffles_neither_index_nor_articles(spark):
    index = spark.createDataFrame([("aa", 0, ["u1", "u9"]), ("bb", 0, ["u2"])], "term string, part int, urls array<string>")
    articles = spark.createDataFrame([("u1", "t1", "c1"), ("u2", "t2", "c2")], "url string, title string, content string")
    asked = spark.createDataFrame([("aa",), ("",), ("zz",)], "keyword string")
    found = sorted(tuple(r) for r in lookup.search(index, articles, asked).collect())
    assert found == [("aa", "u1", "t1", "c1"), ("aa", "u9", None, None)]
    assert lookup.search(index, articles, asked.limit(0)).count() == 0
    plan = lookup.lookup_terms(index, asked)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


CELL = "row string, columnFamily string, qualifier string, timestamp bigint, type string, value string"


def cell(row, qualifier, timestamp, value):
    return (row, "f", qualifier, timestamp, "Put", value)


def test_pivot_ties_nulls_and_missing_columns(spark):
    cells = spark.createDataFrame([
        cell("a", "title", 1, "old"), cell("a", "title", 2, "first"), cell("a", "title", 2, "second"),
        cell("a", "content", None, "no time"), cell("b", "content", 5, None), cell("b", "content", 4, "older"),
        cell("c", "other", 1, "x"), cell(None, "title", 1, "no key"), cell(None, "content", 1, "no key either"),
    ], CELL).coalesce(1)
    got = {tuple(r) for r in articles.from_cells(cells).collect()}
    assert got == {("a", "second", None), ("b", None, None), ("c", None, None), (None, "no key", "no key either")}
    assert articles.from_cells(cells.limit(0)).collect() == []


def test_pivot_sorts_no_values(spark):
    n = 3000
    cells = spark.range(n).selectExpr(
        "concat('u', id) as row", "'f' as columnFamily", "'content' as qualifier", "id as timestamp", "'Put' as type",
        "repeat('v', 50) as value")
    wide = articles.from_cells(cells)
    assert wide.where("content is not null and title is null").count() == n
    plan = wide._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
    # the only aggregate knows keys, times and places
    assert not any("value" in line for line in plan.splitlines() if "Aggregate" in line)
