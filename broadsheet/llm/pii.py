"""Personal data by patterns and by bootstrapped contextual extraction, in SQL functions only.

Base spans of four kinds come from regular expressions and checks. A fifth kind, ``secret``, has seeds
of its own: values assigned to one of ``SECRET_NAMES``. Both are the seeds: one to three words before an
identifier-like token, the word after it, and both sides together, each with the token's shape, are its
lexical patterns. Values and patterns form a weighted graph, and a few rounds score patterns by the known
values they hold and values by their patterns; a seed's value is known wherever it stands, so its other
places teach other patterns. Patterns that hold enough different seeds and are confident enough add the
unseen values at their places as spans of the kind. A number that fails the check digit of its kind is
never added.

Positions are running sums over the texts between matches, built in blocks of the root of their number, so
a text's work grows with its length and with the power 1.5 of its matches. Spans and tokens meet in a
window over one text's sorted rows, which spills; edges are counted per task before they are shuffled.

Edge cases: a null text is empty and has no span; tokens at the ends of a text have patterns of an empty
word; repeated rows are found each; a text that is one token is one candidate, however long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bind
from ..session import written

KINDS = ("email", "ip", "card", "phone")
#: Possessive forms of the patterns; their matches are the leftmost ones.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without it have no match.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: Names whose assigned values are seeds of the kind ``secret``.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "api_key", "api-key", "apikey", "access_key",
                "access-key", "private_key", "secret_key", "client_secret", "auth_token", "access_token")
#: An assignment to such a name; the value has a digit and at least twelve characters.
SECRET = (r"(?i)(?<=(?<![a-z])(?:" + "|".join(SECRET_NAMES) + r")[\"']?\s{0,3})[:=]=?\s{0,3}[\"']?"
          r"(?=[a-z+/_~-]*+[0-9])[a-z0-9+/_~-]{12,}+={0,2}")
ALL_KINDS = (*KINDS, "secret")
#: Tokens with a digit or an at sign: what a pattern may hold.
CANDIDATE = r"(?<!\S)(?:\S*[0-9@]\S*)"
#: A long run in which letters and digits alternate.
MIXED = r"(?<![\p{L}0-9])(?=\p{L}*+[0-9])(?=[0-9]*+\p{L})[\p{L}0-9]{12,}+"
ROUNDS, MIN_SEEDS, MIN_SCORE = 3, 5, 0.9
#: Characters of a text beside a token that its contexts are taken from.
REACH = 60
SPAN = "array<struct<kind: string, start: int, end: int, value: string>>"


def scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``combine``, one for each value.

    Appending to a list copies it, so lists grow in blocks of the root of their number.
    """
    def plain(block: Column) -> Column:
        return F.aggregate(
            F.slice(block, F.lit(2), F.greatest(F.size(block) - 1, F.lit(0))), F.slice(block, F.lit(1), F.lit(1)),
            lambda done, value: F.concat(done, F.array(combine(F.element_at(done, -1), value))))

    def joined(parts: Column) -> Column:
        return bind(plain(F.transform(parts, lambda part: F.element_at(part, -1))), lambda ends: F.flatten(F.transform(
            parts, lambda part, i: F.when(i == 0, part).otherwise(
                F.transform(part, lambda value: combine(F.get(ends, i - 1), value))))))

    def blocks(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values))).cast("int")
        starts = F.sequence(F.lit(0), F.size(values) - 1, width)
        return F.transform(starts, lambda start: plain(F.slice(values, start + 1, width)))

    return bind(values, lambda v: F.when(F.size(v) > 2, bind(blocks(v), joined)).otherwise(plain(v)))


def placed(found: Column, gaps: Column) -> Column:
    """Matches ``found`` between ``gaps`` as ``struct(value, start, end)``, positions in code points."""
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                         lambda gap, value: F.char_length(gap) + F.char_length(value))
    return bind(scan(lengths, lambda a, b: a + b), lambda ends: F.transform(found, lambda value, i: F.struct(
        value.alias("value"), (F.get(ends, i) - F.char_length(value)).alias("start"), F.get(ends, i).alias("end"))))


def matches(text: Column, pattern: str) -> Column:
    """All matches as ``struct(value, start, end)``, positions in code points; null if there are none."""
    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, bind(F.split(text, pattern, -1), lambda gaps: placed(found, gaps))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check: from the right, every second digit is doubled."""
    figures = F.split(F.reverse(number), "")
    total = F.aggregate(
        F.transform(figures, lambda d, i: F.when(
            i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ).otherwise(d.cast("int"))), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.try_to_number(F.right(p, F.lit(3)), F.lit("999")), F.lit(0)) <= 255))
    if kind == "card":
        return F.char_length(digits(value)).between(16, 19) & luhn(digits(value))
    if kind == "phone":
        return F.char_length(digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans ``struct(kind, start, end, value)`` by kind, then start."""
    nothing = F.array().cast(SPAN)

    def of(kind: str) -> Column:
        found = F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
        spans = F.transform(found, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))
        return F.coalesce(F.when(F.contains(text, F.lit(NEEDED[kind])), spans), nothing)

    return F.concat(*(of(kind) for kind in KINDS))


def secret_spans(text: Column) -> Column:
    """Seeds of the kind ``secret``: values assigned to a listed name."""
    def span(m: Column) -> Column:
        value = F.regexp_replace(m["value"], r"^[:=]=?\s*[\"']?", "")
        return F.struct(F.lit("secret").alias("kind"), (m["end"] - F.char_length(value)).alias("start"),
                        m["end"].alias("end"), value.alias("value"))

    assigns = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    return F.coalesce(F.when(assigns, F.transform(matches(text, SECRET), span)), F.array().cast(SPAN))


def shape(value: Column) -> Column:
    """Mixed runs as ~, runs of up to three digits as #, digits of longer ones as 9 each, letters as a."""
    mixed = F.regexp_replace(value, MIXED, "~")
    short = F.regexp_replace(mixed, "(?<![0-9])[0-9]{1,3}(?![0-9])", "#")
    return F.regexp_replace(F.regexp_replace(short, "[0-9]", "9"), r"\p{L}+", "a")


def contexts(left: Column, right: Column) -> Column:
    """The patterns' words: one to three before, one after, one on both sides; digits are alike."""
    def words(side: Column) -> Column:
        return F.split(F.regexp_replace(F.lower(side), "[0-9]", "0"), r"\s+")

    def named(before: Column, after: Column) -> Column:
        # the last piece of the left side is glued to the token, so is the first one of the right side
        def last(k: int) -> Column:
            return F.array_join(F.slice(before, F.greatest(F.size(before) - k, F.lit(1)), F.lit(k + 1)), " ")

        following = F.array_join(F.slice(after, F.lit(1), F.lit(2)), " ")
        return F.array_distinct(F.array(
            *(F.concat(F.lit(f"{k}<"), last(k)) for k in (1, 2, 3)), F.concat(F.lit(">"), following),
            F.concat(F.lit("1<"), last(1), F.lit(" > "), following)))

    return bind(words(left), lambda before: bind(words(right), lambda after: named(before, after)))


def candidates(text: Column) -> Column:
    """Identifier-like tokens ``struct(value, start, end, contexts)``; empty if there are none.

    A name with an equals sign, a quote or a bracket before the value isn't part of it, nor are
    marks at its ends. What a context reaches ends at the second next candidate.
    """
    def token(found: Column, gaps: Column, m: Column, i: Column) -> Column:
        rest = F.regexp_replace(m["value"], r"(?s)^.*[=\"'(<\[{](?=[\p{L}0-9+])", "")
        core = F.regexp_extract(rest, r"(?s)[\p{L}0-9+](?:.*[\p{L}0-9])?", 0)
        start = m["end"] - F.char_length(rest) + F.instr(rest, core) - 1
        return bind(F.struct(core.alias("value"), start.alias("start"), (start + F.char_length(core)).alias("end")),
                    lambda t: F.struct(t["value"].alias("value"), t["start"].alias("start"), t["end"].alias("end"), contexts(
                        F.right(F.concat(F.coalesce(F.get(found, i - 1), F.lit("")), F.get(gaps, i),
                                         F.left(m["value"], t["start"] - m["start"])), F.lit(REACH)),
                        F.left(F.concat(F.right(m["value"], m["end"] - t["end"]), F.get(gaps, i + 1),
                                        F.coalesce(F.get(found, i + 1), F.lit(""))), F.lit(REACH))).alias("contexts")))

    def tokens(found: Column, gaps: Column) -> Column:
        return F.filter(F.transform(placed(found, gaps), lambda m, i: token(found, gaps, m, i)),
                        lambda t: F.char_length(t["value"]) > 5)

    nothing = F.array().cast("array<struct<value: string, start: int, end: int, contexts: array<string>>>")
    return bind(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, bind(F.split(text, CANDIDATE, -1), lambda gaps: tokens(found, gaps))).otherwise(nothing))


def marked(table: DataFrame) -> DataFrame:
    """The ``tokens`` of ``table`` as rows ``(place, start, end, value, contexts, code)``.

    ``code`` is the number of the kind of the span in ``base`` or ``secrets`` at just that place, null
    for an unseen token. A token that another span only touches is left out: its value is not known
    as a whole. One text's rows are sorted, once up and once down, and never held together.
    """
    kinds = F.array(*map(F.lit, ALL_KINDS))
    tokens = table.where(F.size("tokens") > 0).select("place", F.explode("tokens").alias("t")).select(
        "place", "t.*", F.lit(None).cast("int").alias("code"), F.lit(True).alias("token"))
    spans = table.select("place", F.explode(F.concat("base", "secrets")).alias("s")).select(
        "place", "s.start", "s.end", F.array_position(kinds, F.col("s.kind")).cast("int").alias("code"),
        F.lit(False).alias("token"))
    rows = tokens.unionByName(spans, allowMissingColumns=True)
    same = Window.partitionBy("place", "start", "end")
    rows = rows.select("*", F.max("code").over(same).alias("__code"), F.max("token").over(same).alias("__met")).where(
        "token or not __met")
    before = Window.partitionBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__end", F.max(F.expr("if(token, null, end)")).over(before.orderBy("start", "end")))
    rows = rows.withColumn("__start", F.min(F.expr("if(token, null, start)")).over(
        before.orderBy(F.desc("start"), F.desc("end"))))
    return rows.where("token and coalesce(__end <= start, true) and coalesce(__start >= end, true)").select(
        "place", "start", "end", "value", "contexts", F.col("__code").alias("code"))


def possible(kind: Column, value: Column) -> Column:
    """False for a value that fails the check digit of the kind."""
    return (kind != "card") | valid("card", value)


def score_patterns(tokens: DataFrame) -> DataFrame:
    """Confident patterns ``(context, shape, code, confidence)`` from ``(context, shape, value, code)``.

    Nodes are patterns ``(context, shape)`` and values. In each round a pattern's score for a kind is
    the share of its values' weight that is of the kind, and an unseen value's score is that of the
    noisy-or over its patterns. A round is two aggregations over the edges.
    """
    edges = written(
        tokens.groupBy("context", "shape", "value")
        .agg(F.count("*").cast("double").alias("n"), F.max("code").alias("code")), "pii-counts")
    seeds = written(edges.where("code is not null").groupBy("value").agg(
        F.max("code").alias("code"), F.lit(1.0).alias("belief")), "pii-seeds")
    # only patterns that hold a seed can gain a score
    seeded = edges.join(seeds.select("value"), "value", "left_semi").select("context", "shape").distinct()
    edges = written(edges.drop("code").join(seeded, ["context", "shape"], "left_semi"), "pii-edges")
    unseen = edges.join(seeds.select("value"), "value", "left_anti").select("context", "shape", "value")
    kind = F.element_at(F.array(*map(F.lit, ALL_KINDS)), F.col("code"))
    values, patterns = seeds, None
    for _ in range(ROUNDS):
        sums = edges.join(values, "value", "left").groupBy("context", "shape", "code").agg(
            F.sum(F.col("n") * F.coalesce("belief", F.lit(0.0))).alias("good"),
            F.sum("n").alias("n"), F.sum(F.when(F.col("belief") == 1.0, 1).otherwise(0)).alias("seeds"))
        totals = sums.groupBy("context", "shape").agg(F.sum("n").alias("total"))
        patterns = written(
            sums.where("code is not null").join(totals, ["context", "shape"])
            .select("context", "shape", "code", "seeds", (F.col("good") / F.col("total")).alias("confidence")), "pii-patterns")
        held = (
            unseen.join(patterns.where(F.col("seeds") >= MIN_SEEDS), ["context", "shape"]).where(
                possible(kind, F.col("value")))
            .groupBy("value", "code").agg((1 - F.exp(F.sum(F.log(1.000001 - F.col("confidence"))))).alias("belief"))
            .groupBy("value").agg(F.max(F.struct("belief", "code")).alias("best"))
            .select("value", "best.code", F.least("best.belief", F.lit(0.99)).alias("belief"))
        )
        values = seeds.unionByName(held)
    return patterns.where((F.col("confidence") >= MIN_SCORE) & (F.col("seeds") >= MIN_SEEDS))


def with_patterns(tokens: DataFrame) -> DataFrame:
    """One row for each context of a token, with the token's shape."""
    return tokens.withColumn("context", F.explode("contexts")).withColumn("shape", shape(F.col("value"))).drop("contexts")


def find_spans(docs: DataFrame) -> DataFrame:
    """``docs`` in a struct ``row``, beside it ``base`` and ``added`` spans.

    Runs the scoring rounds when called; the rows with their spans are written once.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    table = written(docs.select(F.struct("*").alias("row")).select(
        "row", base_spans(text).alias("base"), secret_spans(text).alias("secrets"), candidates(text).alias("tokens"),
        F.monotonically_increasing_id().alias("place")), "pii")
    tokens = written(marked(table), "pii-tokens")
    patterns = score_patterns(with_patterns(tokens))
    kinds = F.array(*map(F.lit, ALL_KINDS))
    learned = (
        with_patterns(tokens.where("code is null").drop("code")).join(patterns, ["context", "shape"])
        .groupBy("place", "start", "end").agg(
            F.max(F.struct("confidence", "code"))["code"].alias("code"), F.first("value").alias("value"))
        .withColumn("kind", F.element_at(kinds, F.col("code")))
        .where(possible(F.col("kind"), F.col("value")))
    )
    added = written(learned.groupBy("place").agg(F.array_sort(F.collect_list(
        F.struct("kind", "start", "end", "value"))).alias("learned")), "pii-added")
    return table.join(added, "place", "left").select(
        "row", "base", F.concat("secrets", F.coalesce("learned", F.array().cast(SPAN))).alias("added"))


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def written_spans(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, joined by commas."""
    order = F.array(*map(F.lit, ALL_KINDS))
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("k"), s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["s"], s["e"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with ``spans``, sorted by start, replaced by their kinds; overlapping ones by the first.

    Texts are cut into blocks of spans before each span is cut, as a cut counts from its text's begin.
    """
    def pieces(ends: Column) -> Column:
        cuts = F.transform(spans, lambda s, i: F.struct(
            F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("from"), s["start"].alias("to"),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mark")))
        return F.filter(cuts, lambda c: c["to"] >= c["from"])

    def block(cuts: Column) -> Column:
        begin = F.get(cuts, F.lit(0))["from"]
        part = F.substring(text, begin + 1, F.element_at(cuts, -1)["to"] - begin)
        return bind(part, lambda part: F.array_join(F.transform(cuts, lambda c: F.concat(
            F.substring(part, c["from"] - begin + 1, c["to"] - c["from"]), c["mark"])), ""))

    def whole(cuts: Column, ends: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(cuts))).cast("int")
        starts = F.sequence(F.lit(0), F.size(cuts) - 1, width)
        blocks = F.transform(starts, lambda start: bind(F.slice(cuts, start + 1, width), block))
        return F.concat(F.array_join(blocks, ""), F.substring(text, F.element_at(ends, -1) + 1, F.char_length(text)))

    return bind(scan(F.transform(spans, lambda s: s["end"]), F.greatest),
                lambda ends: bind(pieces(ends), lambda cuts: whole(cuts, ends)))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans as one."""
    found = find_spans(docs)
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.col("row.text")
    new = F.when(F.size(spans) > 0, bind(spans, lambda s: masked(text, s))).otherwise(text)
    return found.select("row", new.alias("new")).select(*(
        F.col("new").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
