import re

import numpy as np

import corpus_pipeline
from broadsheet.llm import decontaminate, packing, pii, quality, simhash
from test_packing import slow_ids

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_and_the_end_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    state = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = corpus_pipeline.written(stage(spark, state, FOLDER), f"t-{name}")
        assert state.columns == columns
        kept[name] = {r.doc_id: r.text for r in state.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).where("score >= 0.3").select("row.doc_id").collect()}
    assert set(kept["quality"]) == good
    prints = {i: simhash.text_fingerprint(t) for i, t in kept["quality"].items()}
    seen = {}
    for i in sorted(prints):  # the smallest id of each class stays
        linked = [j for j in prints if bin(prints[i] ^ prints[j]).count("1") <= 4]
        roots = {seen[j] for j in linked if j in seen} | {i}
        for j in [j for j, r in seen.items() if r in roots]:
            seen[j] = min(roots)
        seen[i] = min(roots)
    assert set(kept["near_duplicates"]) == set(seen.values())
    items = decontaminate.Items([tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()])
    clean = {i: t for i, t in kept["near_duplicates"].items() if not items.search(t, 0.8)}
    assert set(kept["decontamination"]) == set(clean)
    for i, text in kept["personal_data"].items():
        assert not re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]", text)
        assert text == texts[i] or re.search(r"\[(?:EMAIL|IP|CARD|PHONE)\]", text)
    got = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, state, FOLDER).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.ids))
    assert {i: np.frombuffer(b"".join(x for _, x in sorted(p)), "<u4").tolist() for i, p in got.items()} == {
        i: slow_ids(t) for i, t in kept["personal_data"].items()}
    assert sum(len(p) for p in got.values()) == corpus_pipeline.run(spark, FOLDER).count()


def test_stages_on_edge_cases(spark, make_docs):
    docs = make_docs((1, None), (2, ""), (None, "a b c mail x@y.com"), (3, "w " * 100_000), (3, "w " * 100_000))
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, FOLDER).columns == docs.columns
            stage(spark, rows, FOLDER).collect()
        corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER).collect()
