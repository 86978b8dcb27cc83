"""The operators' queries against their SQL."""

import pytest

from broadsheet.llm.oracle import ORACLE
from broadsheet.llm.queries import QUERIES
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER).execute(ORACLE[name]).df()) is None
