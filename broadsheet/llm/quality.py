"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees are grown on statistics of labelled texts, every path from a root is a conjunctive rule, a
lasso logistic regression keeps few rules, and the kept rules are compiled into column expressions.
Scoring is therefore a projection: no shuffle, no Python.

Edge cases: a null text counts as empty; every statistic of an empty text is 0, so it has a score.
Without labels of both kinds the score is constant: the share of label 1, or 0.5 without labels.
Labels that are null are ignored, repeated labels of a document count once, by the lower one.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from ..session import written

#: At most so many labelled rows are used for fitting, those with the lowest hash of the id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.002, 7
#: Scores at or above it predict label 1.
THRESHOLD = 0.3

#: Statistics that count matches per word.
PATTERNS = {
    "symbol_runs": r"[!-/:-@\[-`{-~]{2,}",
    "lone_symbols": r"\s[!-/:-@\[-`{-~]+(?=\s)",
    "capital_words": r"[A-ZÀ-ÖØ-Þ]{2,}",
    "short_words": r"\b\p{L}{1,3}\b",
    "numbers": r"[0-9]+",
    "sentence_ends": r"[.!?](?:\s|$)",
    "commas": ",",
}
NAMES = ("chars", "words", "lines", "chars_per_word", "distinct_words", "distinct_lines", *PATTERNS)


def statistics(text: Column | str) -> Column:
    """A struct of the statistics; shares are per word, line or character and 0 for an empty text.

    The counts are bound before they are divided, so the text is cut into words once.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def distinct(parts: Column, name: str) -> Column:
        return bind(parts, lambda p: F.struct(
            F.size(p).cast("double").alias("all"), F.size(F.array_distinct(p)).cast("double").alias("distinct"),
        )).alias(name)

    def shares(c: Column) -> Column:
        words, lines = c["words"]["all"], c["lines"]["all"]
        return F.struct(*(value.alias(name) for name, value in zip(NAMES, (
            c["chars"], words, lines, c["chars"] / words, c["words"]["distinct"] / words, c["lines"]["distinct"] / lines,
            *(c[name] / words for name in PATTERNS),
        ), strict=True)))

    return bind(F.struct(
        F.char_length(text).cast("double").alias("chars"),
        distinct(F.split(F.lower(text), r"\s+"), "words"),
        distinct(F.split(text, "\n"), "lines"),
        *(F.regexp_count(text, F.lit(pattern)).cast("double").alias(name) for name, pattern in PATTERNS.items()),
    ), shares)


@dataclass(frozen=True)
class Condition:
    """``statistic <= bound`` or, if ``above``, ``statistic > bound``."""

    statistic: str
    above: bool
    bound: float

    def column(self, value_of: Callable[[str], Column] = F.col) -> Column:
        value = value_of(self.statistic)
        return value > F.lit(self.bound) if self.above else value <= F.lit(self.bound)


Rule = frozenset  # of conditions that must all hold


@dataclass
class RuleModel:
    """Kept rules with weights; ``constant`` replaces them where nothing could be learned."""

    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)
    constant: float | None = None

    def score(self, value_of: Callable[[str], Column] = F.col) -> Column:
        """The probability of label 1; ``value_of`` gives the column of a statistic."""
        if self.constant is not None:
            return F.lit(self.constant)
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, value_of), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: Rule, value_of: Callable[[str], Column] = F.col) -> Column:
    column = F.lit(True)
    for condition in sorted(rule, key=lambda c: (c.statistic, c.above, c.bound)):
        column = column & condition.column(value_of)
    return column


_SPLIT = re.compile(r"(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)")


def paths(tree: str) -> set[Rule]:
    """The rules of a tree in its printed form: one for each node below the root.

    Of several conditions on one statistic in one direction only the tightest stays.
    """
    found: set[Rule] = set()
    above: list[Condition] = []
    for line in tree.splitlines():
        if (match := _SPLIT.match(line.strip())) is None:
            continue
        depth = (len(line) - len(line.lstrip())) - 2
        above = above[:depth] + [Condition(NAMES[int(match[1])], match[2] == ">", float(match[3]))]
        tightest: dict[tuple[str, bool], Condition] = {}
        for c in above:
            old = tightest.get((c.statistic, c.above))
            if old is None or (c.bound > old.bound) == c.above:
                tightest[c.statistic, c.above] = c
        found.add(frozenset(tightest.values()))
    return found


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``label`` and the statistics of at most ``rows`` labelled documents that aren't held out.

    The ids are a bounded table and broadcast, so the texts are not shuffled.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.min("label").cast("double").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"))
    joined = texts.join(F.broadcast(chosen), "id").select(
        "id", "label", statistics("text").alias("statistics")).select("id", "label", "statistics.*")
    return joined.repartition(4, "id").sortWithinPartitions("id", *NAMES)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> RuleModel:
    """Learn rules and weights from the sample. Runs jobs on the bounded sample when called."""
    sample = written(training_sample(docs, labels, rows), "quality-sample")
    kinds = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return RuleModel(constant=next(iter(kinds), 0.5))
    vectors = sample.select("label", array_to_vector(F.array(*NAMES)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, subsamplingRate=0.7,
    ).fit(vectors)
    rules = sorted(
        set().union(*(paths(tree.toDebugString) for tree in forest.trees)),
        key=lambda r: sorted((c.statistic, c.above, c.bound) for c in r),
    )
    if not rules:
        return RuleModel(constant=kinds[1.0] / sum(kinds.values()))
    hits = written(sample.select("label", array_to_vector(
        F.array(*(holds(rule).cast("double") for rule in rules))
    ).alias("features")), "quality-rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(hits)
    kept = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(float(lasso.intercept), kept)


def score(docs: DataFrame, model: RuleModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` in a struct ``row``, beside it ``name``; nothing is shuffled.

    The statistics are bound before they are compared: as plain columns the optimizer would copy
    them into every rule of a filter on the score, and each copy would read the text again.
    """
    value = bind(statistics(text), lambda s: model.score(s.getField))
    return docs.select(F.struct("*").alias("row"), value.alias(name))


def keep_good(docs: DataFrame, labels: DataFrame, model: RuleModel | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject."""
    scored = score(docs, model or fit(docs, labels))
    return scored.where(F.col("score") >= THRESHOLD).select("row.*")
