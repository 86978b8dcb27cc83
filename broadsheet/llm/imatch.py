"""Document fingerprints by I-Match over randomised sub-lexicons, in SQL functions only.

Terms are runs of letters and digits in lower case, known by their 64-bit hash. Each level of
``LEVELS`` deals the terms into random sub-lexicons, so that long and short texts both have some
that keep few of their terms. Of the terms in a sub-lexicon only those stay whose share of documents
lies in a band, that is, an inverse document frequency band. A component of the fingerprint is the
hash of the sorted distinct terms that a text has in one sub-lexicon. A text with no such term at
all has one component instead, the hash of all its sorted distinct terms.

At least one in ``1 / LOW`` documents has each term of the lexicon, so it holds at most that many
times the mean number of distinct terms; it is broadcast inside checked bounds and joined plainly
beyond. Texts are scanned once; only hashes of sampled terms are exploded and grouped.

Edge cases: a null text is empty; a text without terms has the fingerprint of the empty set. Null
ids come first, rows with equal ids are ordered by a hash of the text, and a single row is its own
next document.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_within, written

#: Shares of documents between which a term is kept; it must be in two documents at least.
LOW, HIGH = 0.0005, 0.2
#: (sub-lexicons into which the terms are dealt, how many of them are used)
LEVELS = ((32, 8), (128, 16), (512, 16))
#: Bounds of the broadcast lexicon.
LEXICON_ROWS, LEXICON_BYTES = 2_000_000, 1 << 25


def all_terms(text: Column) -> Column:
    """Sorted hashes of the distinct terms of a text that isn't null."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{Nd}]+"))
    return F.array_sort(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def dealt(term: Column) -> list[Column]:
    """At each level the number of the term's sub-lexicon."""
    return [F.shiftrightunsigned(term, 12 * k + 4).bitwiseAND(F.lit(size - 1))
            for k, (size, _) in enumerate(LEVELS)]


def sampled(terms: Column) -> Column:
    """The terms of the sub-lexicons in use."""
    return F.filter(terms, lambda t: reduce(
        lambda a, b: a | b, (part < used for part, (_, used) in zip(dealt(t), LEVELS))))


def digest(terms: Column) -> Column:
    return F.shiftright(F.xxhash64(terms), 32).cast("int")


def components(terms: Column, whole: Column) -> Column:
    """The fingerprint of a text from its sorted terms in the lexicon and the digest of all terms."""
    def component(level: int, part: int) -> Column:
        own = F.filter(terms, lambda t: dealt(t)[level] == part)
        return F.when(F.size(own) > 0, digest(own))

    return F.array(F.when(F.size(terms) == 0, whole), *(
        component(level, part) for level, (_, used) in enumerate(LEVELS) for part in range(used)))


def written_out(fingerprint: Column) -> Column:
    """Eight hex digits for each component, a dash for an empty one."""
    return F.array_join(F.transform(fingerprint, lambda c: F.coalesce(
        F.lpad(F.lower(F.hex(c.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"), F.lit("-"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal components among those that either fingerprint has."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x == y, F.lit(False))))
    used = F.filter(pairs, lambda p: p.isNotNull())
    return F.when(F.size(used) == 0, 1.0).otherwise(F.size(F.filter(used, lambda p: p)) / F.size(used))


def learn_lexicon(terms: DataFrame, rows: int, low: float = LOW, high: float = HIGH) -> DataFrame:
    """The terms in the band, from ``terms(term)`` that has each document's distinct terms."""
    return written(
        terms.groupBy("term").count()
        .where((F.col("count") >= max(2.0, low * rows)) & (F.col("count") <= high * rows))
        .select("term"), "lexicon")


def listed(values: Sequence, kind: str) -> Column:
    """The values as an array: one literal of the plan, however many they are."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with place ``(bucket, rank)``, the next row's text and place.

    Ids are dealt into buckets by quantiles. The first row of each bucket is also a guest at the end
    of the bucket before it, and that of the first bucket at the end of the last one, so one window
    within buckets is enough and no text goes through the driver.
    """
    spark = docs.sparkSession
    wanted = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = docs.agg(F.percentile_approx("doc_id", [k / wanted for k in range(1, wanted)], 20 * wanted)).first()[0]
    splits = listed(sorted(set(bounds or ())), "bigint")
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(splits, lambda s: s < F.col("doc_id"))))
    docs = docs.withColumns({"bucket": bucket, "tie": F.xxhash64("text")})
    firsts = sorted(docs.groupBy("bucket").agg(
        F.min_by(F.struct("doc_id", "tie"), F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")).alias("first")
    ).select("bucket", "first.*").collect())
    seats = [None] * (firsts[-1]["bucket"] + 1 if firsts else 0)
    for r, before in zip(firsts, firsts[-1:] + firsts[:-1]):
        seats[r["bucket"]] = {"doc_id": r["doc_id"], "tie": r["tie"], "host": before["bucket"]}
    first = F.get(listed(seats, "struct<doc_id: bigint, tie: bigint, host: int>"), F.col("bucket"))
    host = F.when(F.col("doc_id").eqNullSafe(first["doc_id"]) & (F.col("tie") == first["tie"]), first["host"])
    spread = docs.withColumn("host", host).select(
        "doc_id", "text", "bucket", "tie", F.explode(F.filter(F.array(
            F.struct(F.col("bucket").alias("at"), F.lit(False).alias("guest")),
            F.struct(F.col("host").alias("at"), F.lit(True).alias("guest")),
        ), lambda s: s["at"].isNotNull())).alias("seat")).select("*", "seat.*").drop("seat")
    order = Window.partitionBy("at").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie")
    rank = F.row_number().over(order)
    return spread.select(
        "doc_id", "text", "bucket", "guest", rank.alias("rank"), F.lead("text").over(order).alias("next_text"),
        F.lead("bucket").over(order).alias("next_bucket"),
        F.when(F.lead("guest").over(order), 1).otherwise(rank + 1).alias("next_rank"),
    ).where(~F.col("guest")).drop("guest")


def edited(text: Column, following: Column) -> Column:
    """The text whose last quarter of code points gives way to the first as many of ``following``."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.left(text, n - quarter), F.left(following, quarter))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """For each row its place, the next one's, ``fp`` of its text and ``edited_fp`` of its edited text."""
    texts = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text"))).select(
        "doc_id", "bucket", "rank", "next_bucket", "next_rank", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        all_terms(F.col("text")).alias("a"), all_terms(F.col("edited")).alias("b"))
    table = written(texts.withColumns({"sa": sampled(F.col("a")), "sb": sampled(F.col("b"))}).select(
        "doc_id", "bucket", "rank", "next_bucket", "next_rank", "n_chars", "edited_sha256",
        digest(F.col("a")).alias("whole"), digest(F.col("b")).alias("edited_whole"),
        F.array_intersect("sa", "sb").alias("both"), F.array_except("sa", "sb").alias("old"),
        F.array_except("sb", "sa").alias("new")), "terms")
    lexicon = learn_lexicon(table.select(F.explode(F.concat("both", "old")).alias("term")), table.count())
    bounded = broadcast_within(lexicon, LEXICON_ROWS, LEXICON_BYTES, F.lit("12345678"))

    def sided(name: str, side: int) -> Column:
        return F.transform(name, lambda t: F.struct(t.alias("term"), F.lit(side).alias("side")))

    sides = [sided(name, side) for side, name in enumerate(("both", "old", "new"))]
    known = (
        table.select("bucket", "rank", F.explode(F.concat(*sides)).alias("t")).select("bucket", "rank", "t.*")
        .join(lexicon if bounded is None else bounded, "term")
        .groupBy("bucket", "rank").agg(F.array_sort(F.collect_list(F.struct("term", "side"))).alias("terms"))
    )

    def of(other: int) -> Column:
        return F.transform(F.filter(F.coalesce("terms", F.array().cast("array<struct<term: bigint, side: int>>")),
                                    lambda t: t["side"] != other), lambda t: t["term"])

    joined = table.drop("both", "old", "new").join(known, ["bucket", "rank"], "left").withColumns(
        {"ours": of(2), "theirs": of(1)})
    return joined.select(
        "doc_id", "bucket", "rank", "next_bucket", "next_rank", "n_chars", "edited_sha256",
        components(F.col("ours"), F.col("whole")).alias("fp"),
        components(F.col("theirs"), F.col("edited_whole")).alias("edited_fp"))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and edited texts, and how like they are to each other and the next one."""
    pairs = written(fingerprint_pairs(docs), "fingerprint-pairs")
    following = pairs.select(
        F.col("bucket").alias("next_bucket"), F.col("rank").alias("next_rank"), F.col("fp").alias("next_fp"))
    return pairs.join(following, ["next_bucket", "next_rank"]).select(
        "doc_id", "n_chars", "edited_sha256",
        written_out(F.col("fp")).alias("fingerprint"), written_out(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
