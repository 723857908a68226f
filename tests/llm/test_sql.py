import pytest

from tidemark.llm import queries as Q

from ..oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(Q.oracle_sql()))
def test_query_matches_its_sql(spark, key):
    status, n, m, diffs = compare(spark, SF, key, Q.queries()[key], Q.oracle_sql()[key], duck(SF))
    assert status == "OK", (status, n, m, diffs)
