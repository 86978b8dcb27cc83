"""Licence scan by a trained paragraph classifier.

A multinomial logistic regression with a lasso penalty over word one- and two-grams tells licence
families from an unknown class. It is trained on parts of the family's notices and on a bounded
sample of the corpus's own paragraphs as unknown; probabilities are calibrated by a second logistic
regression on paragraphs not trained on. A predicted family counts only if the paragraph's word
pairs are confirmed by one of its notices. Texts are scored where they lie, paragraph by paragraph,
whole; nothing is shuffled but the training sample.

Edge cases: null and empty texts hold no paragraph; a paragraph without a known n-gram is unknown;
each paragraph is reported for itself, so repeated ones are found each.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents from which at most so many paragraphs are taken as unknown, by the hash of their id.
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS = 1_000, 3_000
VARIANTS, PENALTY, SEED = 40, 0.0005, 11
#: A family is reported if its calibrated probability and its word pairs' share reach these.
MIN_PROBABILITY, MIN_CONFIRMED = 0.5, 0.6

#: Notices of licence families (fixed values).
NOTICES = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal.",
        "This work is dedicated to the public domain.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
}
#: Sentences that use the same words without granting anything (fixed values).
OTHER = (
    "He lost his driving license in the spring.", "All rights reserved.", "The license fee is due in May.",
    "They asked for permission to use the general public library.", "The work is under way.",
    "This is free of charge for any person.", "Copyright questions are answered by the office.",
    "The mit students released their work under a new name.", "Version 2.0 of the program is out.",
)
FAMILIES = ("unknown", *NOTICES)
_WORD = re.compile(r"\w+")
_PARAGRAPH = re.compile(r"[^\n]+")
FOUND = "array<struct<family: string, start: int, end: int, probability: double, confirmed: double>>"
_FOUND = pa.list_(pa.struct([
    ("family", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
    ("probability", pa.float64()), ("confirmed", pa.float64()),
]))


def grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(["", *words], [*words, ""]))


@dataclass
class LicenceModel:
    """Weights ``(gram, family)``, the calibration and the notices' word pairs."""

    numbers: dict[str, int]
    weights: np.ndarray
    intercepts: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        self.notices = {f: [pairs(_WORD.findall(n.lower())) for n in ns] for f, ns in NOTICES.items()}
        used = np.flatnonzero(np.abs(self.weights).sum(axis=1))
        self.known = {g for g, k in self.numbers.items() if k in set(used.tolist())}
        self.words = {w for g in self.known for w in g.split(" ")}

    def margins(self, words: list[str]) -> np.ndarray:
        at = [self.numbers[g] for g in grams(words) & self.known]
        return self.intercepts + self.weights[at].sum(axis=0)

    def classify(self, words: list[str]) -> tuple[str, float, float] | None:
        """Family, probability and confirmed share, if the paragraph is of a known family."""
        if self.words.isdisjoint(words):
            return None
        margins = self.margins(words)
        best = int(np.argmax(margins[1:])) + 1
        probability = 1 / (1 + np.exp(-np.clip(self.slope * (margins[best] - margins[0]) + self.shift, -60, 60)))
        if probability < MIN_PROBABILITY:
            return None
        own = pairs(words)
        # the notice may be part of a longer paragraph, or the paragraph a part of the notice
        confirmed = max(len(own & n) / min(len(own), len(n)) for n in self.notices[FAMILIES[best]])
        return (FAMILIES[best], float(probability), confirmed) if confirmed >= MIN_CONFIRMED else None

    def scan(self, text: str | None) -> list[dict]:
        found = []
        for m in _PARAGRAPH.finditer(text or ""):
            if hit := self.classify(_WORD.findall(m[0].lower())):
                found.append(dict(zip(("family", "start", "end", "probability", "confirmed"),
                                      (hit[0], m.start(), m.end(), *hit[1:]))))
        return found


def _examples(unknown: list[str]) -> list[tuple[float, list[str]]]:
    """Whole and shortened notices, each family equally often, and paragraphs of the unknown class."""
    chance = random.Random(SEED)
    rows = [(0.0, _WORD.findall(p.lower())) for p in (*unknown, *OTHER * 20)]
    background = [w for _, words in rows[:500] for w in words] or ["x"]
    for k, family in enumerate(FAMILIES[1:], 1):
        for n in range(VARIANTS * 4):
            notices = NOTICES[family]
            words = _WORD.findall(notices[n % len(notices)].lower())
            if n >= len(notices):
                words = [w for w in words if chance.random() > 0.05]
                extra = chance.choices(background, k=chance.randrange(0, 6))
                words = (words + extra) if chance.random() < 0.5 else (extra + words)
            rows.append((float(k), words))
    chance.shuffle(rows)
    return rows


def fit(docs: DataFrame) -> LicenceModel:
    """Train on the notices and a bounded sample of paragraphs. Runs jobs when called."""
    spark = docs.sparkSession
    sample = (
        docs.select("doc_id", "text").where("text is not null")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
        .select(F.explode(F.slice(F.split("text", "\n+"), 1, 8)).alias("p"))
        .where(~F.lower("p").rlike("licen[cs]e|copyright|redistribut|public domain")).limit(SAMPLE_PARAGRAPHS)
    )
    rows = _examples([r[0][:2000] for r in sample.collect()])
    numbers = {g: n for n, g in enumerate(sorted(
        set().union(*(grams(_WORD.findall(t.lower())) for ns in (*NOTICES.values(), OTHER) for t in ns))))}

    def vectors(part: list) -> DataFrame:
        return spark.createDataFrame([
            (label, Vectors.sparse(len(numbers), sorted((numbers[g], 1.0) for g in grams(words) if g in numbers)))
            for label, words in part], ["label", "features"]).repartition(2)

    held = len(rows) // 4
    model = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=PENALTY, maxIter=60,
                               standardization=False).fit(vectors(rows[held:]))
    weights, intercepts = model.coefficientMatrix.toArray().T, model.interceptVector.toArray()
    plain = LicenceModel(numbers, weights, intercepts)
    margins = [(float(label > 0), plain.margins(words)) for label, words in rows[:held]]
    known = spark.createDataFrame([(y, Vectors.dense(float(m[1:].max() - m[0]))) for y, m in margins], ["label", "features"])
    scale = LogisticRegression(regParam=0.01, maxIter=40).fit(known)
    return LicenceModel(numbers, weights, intercepts, float(scale.coefficients[0]), float(scale.intercept))


def scan(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """``doc_id`` and a row for each paragraph of a known family; positions in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.scan(t.as_py()) for t in texts], _FOUND)

    return docs.select("doc_id", F.explode(find("text")).alias("found")).select("doc_id", "found.*")
