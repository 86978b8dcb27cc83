import re

import pytest

from broadsheet.llm import licences
from broadsheet.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
#: The notices of the test tables and their families.
PLANTED = {
    r"licensed\W+under\W+the\W+gnu\W+general\W+public\W+license\W+version\W+3": "GPL",
    r"licensed\W+under\W+cc\W+by\W+nc\W+4\W+0": "CC-BY-NC",
    r"released\W+under\W+the\W+mit\W+license": "MIT",
    r"licensed\W+under\W+the\W+apache\W+license\W+version\W+2\W+0": "Apache",
}


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_query_finds_the_planted_notices(spark):
    expected = set()
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        for m in re.finditer(r"[^\n]+", r.text):
            for pattern, family in PLANTED.items():
                if re.search(pattern, m[0].lower()):
                    expected.add((r.doc_id, m.start(), m.end(), family))
    found = {(r.doc_id, r.start, r.end, r.family) for r in QUERIES["op6_licences"](spark, FOLDER).collect()}
    assert found == expected and len(found) > 20


def test_notices_and_others(model):
    for family, notices in licences.NOTICES.items():
        for n in notices:
            hits = model.scan(f"Some words before.\n{n}\nand after")
            assert [h["family"] for h in hits] == [family], n
            assert all(0.5 <= h["probability"] <= 1 for h in hits)
    for other in (*licences.OTHER, "The library opens in May.", "license", "public", "MIT"):
        assert model.scan(other) == [], other


def test_edge_cases(spark, make_docs, model):
    line = "Released under the MIT License."
    docs = make_docs((1, None), (2, ""), (None, line), (3, line), (3, line), (4, "\n\n" + "w " * 200_000 + "\n" + line), (5, f"{line}\n{line}"))
    found = [(r.doc_id, r.family) for r in licences.scan(docs, model).collect()]
    assert sorted(found, key=str) == sorted([(None, "MIT"), (3, "MIT"), (3, "MIT"), (4, "MIT"), (5, "MIT"), (5, "MIT")], key=str)
    assert licences.scan(docs.limit(0), model).count() == 0
    assert licences.scan(docs.limit(0)).count() == 0
