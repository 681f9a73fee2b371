"""Registered queries against DuckDB on the same files."""

import pytest
from compare import connect, difference

from catalograph.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twin(spark, con, name):
    assert difference(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op2_simhash_near_dedup", "op7_packing"])
def test_result_columns(spark, name):
    kinds = {
        "op2_simhash_near_dedup": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
        "op7_packing": [(c, "bigint") for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")],
    }
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").dtypes == kinds[name]
