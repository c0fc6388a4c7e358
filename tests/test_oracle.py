"""Every registered query against its DuckDB oracle on the small tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_harness import compare, duck_connect
from visitlens.plans.oracle import ORACLE
from visitlens.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_batch_query_has_an_oracle():
    missing = [n for n in QUERIES if n not in ORACLE and not n.startswith("stream_")]
    assert missing == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["schema_match"], res
    assert res["rows"][0] == res["rows"][1], res
    assert res["value_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "session_count" in df.columns


def test_entry_without_the_training_data_part(monkeypatch):
    """With the pipeline's module missing only the engine's own queries are listed."""
    import sys
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert entry.queries().keys() == QUERIES.keys() >= entry.oracle_sql().keys()
