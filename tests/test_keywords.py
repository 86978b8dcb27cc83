"""TF-IDF and the index: hand-worked values, and the ways taken by large or skewed input."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from broadsheet import session
from broadsheet.operators import extract, index, keywords, lookup, store
from broadsheet.plans import queries

FOLDER = "/root/testdata/sf0.001"


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "xx xx yy the"), (2, "yy zz")], "doc int, text string")
    idf = spark.createDataFrame([("xx", 2.0), ("yy", 0.5), ("other", 1.0)], "term string, idf double")
    got = keywords.extract_keywords(docs, ["doc"], idf=idf).collect()
    assert {(r.doc, r.term): (r.weight, r["rank"]) for r in got} == {
        (1, "xx"): (round(2 * 2.0 / 3, 6), 1), (1, "yy"): (round(0.5 / 3, 6), 2),
        (2, "zz"): (0.5, 1), (2, "yy"): (0.25, 2)}
    assert keywords.extract_keywords(docs, ["doc"], k=1, idf=idf).count() == 2
    assert keywords.extract_keywords(docs, ["doc"], k=None).count() == 4
    plain = keywords.extract_keywords(docs, ["doc"], with_weight=False)
    assert plain.columns == ["doc", "term", "rank"]


def test_allowed_parts_of_speech(spark):
    docs = spark.createDataFrame([(1, "xx yy zz zz")], "doc int, text string")
    lexicon = spark.createDataFrame([("xx", "n"), ("yy", "v"), ("zz", "x")],
                                    "term string, flag string")
    idf = spark.createDataFrame([("xx", 1.0), ("yy", 3.0), ("zz", 9.0)], "term string, idf double")
    got = keywords.extract_keywords(docs, ["doc"], idf=idf, lexicon=lexicon, allow_pos=("n", "v"),
                                    with_flag=True).collect()
    assert [(r.term, r.flag, r.weight) for r in got] == [("yy", "v", 1.5), ("xx", "n", 0.5)]
    rows = keywords.explode_tokens(docs, ["doc"])
    assert keywords.pos_filter(rows, lexicon, (), empty_keeps_all=True).count() == rows.count()
    assert keywords.pos_filter(rows, lexicon, (), empty_keeps_all=False).count() == 0


def test_split_vocabulary_gives_the_same_weights(spark):
    terms = queries._doc_terms(spark, FOLDER)
    idf = queries._doc_idf(spark, FOLDER)
    whole = keywords.weigh(terms, idf)
    split = keywords.weigh(terms, idf, hot_terms=40)
    assert split.count() == whole.count()
    assert split.select(*whole.columns).exceptAll(whole).isEmpty()
    partial = idf.filter(F.col("df") > 2)
    assert keywords.weigh(terms, partial, hot_terms=40).select(*whole.columns).exceptAll(
        keywords.weigh(terms, partial)).isEmpty()


def test_median_is_the_upper_one(spark):
    for values in ([1.0], [1.0, 2.0], [2.0, 1.0, 2.0, 3.0], [5.0, 1.0, 1.0, 1.0, 7.0]):
        idf = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)],
                                    "term string, idf double")
        assert keywords.median_idf(idf).first()[0] == sorted(values)[len(values) // 2]


def test_idf_of_a_term_in_every_document_is_zero(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "aa")], "doc int, text string")
    idf = keywords.learn_idf(docs)
    assert {r.term: (r.df, r.idf) for r in idf.collect()} == {"aa": (2, 0.0), "bb": (1, math.log(2))}


@pytest.fixture(scope="module")
def postings(spark):
    urls = [(f"u{i:03d}",) for i in range(100)]
    frame = spark.createDataFrame(urls, "url string")
    return frame.select(F.lit("hot").alias("term"), "url").unionByName(
        frame.limit(3).select(F.lit("cold").alias("term"), "url"))


def test_frequent_term_is_parted_and_whole(spark, postings):
    lists = index.posting_lists(postings, max_urls=10)
    parts = defaultdict(list)
    for r in lists.collect():
        assert list(r.urls) == sorted(r.urls)
        parts[r.term].append(r.urls)
    assert len(parts["hot"]) > 5 and len(parts["cold"]) == 1
    assert sorted(u for p in parts["hot"] for u in p) == [f"u{i:03d}" for i in range(100)]
    assert index.posting_lists(postings).count() == 2


def test_search_over_parts(spark, postings, tmp_path):
    path = str(tmp_path / "index")
    store.write_index(index.posting_lists(postings, max_urls=10), path)
    stored = store.read_index(spark, path)
    articles = spark.createDataFrame([("u000", "t", "c")], "url string, title string, content string")
    asked = spark.createDataFrame([("cold",), ("",), ("none",)], "keyword string")
    found = lookup.search(stored, articles, asked).orderBy("url").collect()
    assert [tuple(r) for r in found] == [
        ("cold", "u000", "t", "c"), ("cold", "u001", None, None), ("cold", "u002", None, None)]
    assert sum(len(r.urls) for r in lookup.lookup_term(stored, "hot").collect()) == 100
    assert {r.term for r in lookup.lookup_prefix(stored, "co").collect()} == {"cold"}


def test_index_lists_give_back_the_keywords(spark):
    inverted = queries.invert(spark, FOLDER)
    lists = index.posting_lists(inverted, max_urls=4)
    back = lists.select("term", F.explode("urls").alias("url"))
    assert back.count() == inverted.count()
    assert back.exceptAll(inverted).isEmpty()


def test_invalid_title_is_indexed_as_long_term(spark):
    cells = spark.createDataFrame(
        [("u", "f", "title", 1, "Put", r"\xFF"), ("u", "f", "content", 1, "Put", None)],
        "row string, columnFamily string, qualifier string, timestamp bigint, type string, "
        "value string")
    texts = index.field_texts(cells, "title", "content", escaped=True)
    terms = index.title_tokens(texts, "text")
    assert [tuple(r) for r in index.invert(index.long_terms(terms)).collect()] == [("invalid", "u")]


def test_numbering_in_ranges_equals_row_number(spark):
    items = spark.range(0, 200).select(
        F.when(F.col("id") < 150, "hot").when(F.col("id") < 180, "cold").alias("site"),
        (F.col("id") * 7).alias("order"))
    numbered = extract.number_items(items, ["site"], "order", bucket=30)
    plain = items.withColumn(
        "n", F.row_number().over(Window.partitionBy("site").orderBy("order")) - F.lit(1))
    assert numbered.select(*plain.columns).exceptAll(plain).isEmpty()
    assert numbered.count() == 200


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.broadcast_within(spark.range(10).withColumn("t", F.lit("ab")), 9, 99, "t") is None
    assert session.broadcast_within(spark.range(10).withColumn("t", F.lit("ab")), 10, 19, "t") is None
    assert session.broadcast_within(spark.range(10).withColumn("t", F.lit("ab")), 10, 20, "t")


def test_chinese_articles_are_found(spark, tmp_path):
    articles = spark.createDataFrame([
        ("u1", "五台山举行法会", "山西祈福。"),
        ("u2", "香港演员", "香港演员祈福。Broadcast news"),
        ("u3", "Broadcasting", None),
    ], "url string, title string, content string")
    path = str(tmp_path / "index")
    store.write_index(index.full_index(articles), path)
    asked = spark.createDataFrame([("祈福",), ("香港",), ("Broadcasting",), ("法会",)], "keyword string")
    found = lookup.search(store.read_index(spark, path), articles, asked).collect()
    assert {(r.keyword, r.url) for r in found} == {
        ("祈福", "u1"), ("祈福", "u2"), ("香港", "u2"), ("Broadcasting", "u3"), ("法会", "u1")}


def test_a_term_with_two_flags_counts_once(spark):
    lexicon = spark.createDataFrame([("xx", "v"), ("xx", "n"), ("yy", "n")], "term string, flag string")
    docs = spark.createDataFrame([(1, "xx yy xx")], "doc long, text string")
    idf = spark.createDataFrame([("xx", 1.0), ("yy", 1.0)], "term string, idf double")
    for with_flag in (False, True):
        got = keywords.extract_keywords(docs, ["doc"], idf=idf, lexicon=lexicon, allow_pos=("n", "v"), with_flag=with_flag)
        rows = {r.term: round(r.weight, 3) for r in got.collect()}
        assert got.count() == 2 and rows == {"xx": 0.667, "yy": 0.333}


def test_documents_without_text_count_in_the_idf(spark):
    docs = spark.createDataFrame([("aa",), ("aa bb",), (None,)], "text string")
    learned = {r.term: round(r.idf, 6) for r in keywords.learn_idf(docs).collect()}
    assert learned == {"aa": round(math.log(3 / 2), 6), "bb": round(math.log(3), 6)}


def test_frequent_terms_of_a_large_lexicon_are_not_shuffled(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, " ").when(F.col("id") % 2 == 0, "often").otherwise(
        F.concat(F.lit("w"), F.col("id"))).alias("term"))
    lexicon = spark.createDataFrame([("often", "n"), ("often", "v"), ("w9", "v"), ("w15", "x"), ("none", "n")], "term string, flag string")
    whole = keywords.join_allowed(rows, lexicon, ("n", "v"))
    split = keywords.join_allowed(rows, lexicon, ("n", "v"), max_terms=0, limit=2)
    assert whole.count() == 501 and whole.exceptAll(split.select(*whole.columns)).isEmpty() and split.count() == 501
    counts = rows.groupBy("term").agg(F.count(F.lit(1)).alias("n")).cache()
    assert {r.term for r in keywords.most_frequent(counts, "n", 100).collect()} == {" ", "often"}
    assert keywords.most_frequent(counts, "n", 1).count() == 1 and keywords.most_frequent(counts.limit(0), "n", 5).count() == 0


@pytest.mark.parametrize("bound", [keywords.BROADCAST_TERMS, 0])
def test_flags_and_idf_meet_the_rows_together(spark, monkeypatch, bound):
    docs = spark.createDataFrame(
        [(1, "aa bb cc aa dd"), (2, "aa cc"), (2, "aa cc"), (None, "bb dd ee"), (None, "ee")], "id long, text string")
    lexicon = spark.createDataFrame([("aa", "n"), ("bb", "v"), ("bb", "n"), ("cc", "x"), ("dd", "v"), ("ee", "n")], "term string, flag string")
    monkeypatch.setattr(keywords, "BROADCAST_TERMS", bound)
    idf = keywords.learn_idf(docs)
    terms = keywords.term_frequencies(docs, ["id"])
    for given, complete in ((idf, True), (idf.filter("term <> 'bb'"), False)):
        old = keywords.weigh(keywords.flag_terms(terms, ["id"], lexicon, ("n", "v")), given, complete=complete)
        new = keywords.weigh_flagged(terms, ["id"], lexicon, ("n", "v"), given, complete)
        assert old.count() == new.count() == 9 and old.exceptAll(new.select(*old.columns)).isEmpty()
