"""The operators that SQL can express against their DuckDB statements; the registry."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck_connect
from visitlens.llm.queries import ORACLE, QUERIES

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    res = compare(spark, duck_connect(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["schema_match"] and res["value_match"], res


def test_all_operators_are_registered():
    listed = entry.queries()
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= listed.keys()


BASE_STATS = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
line AS (
  SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM doc)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM line GROUP BY doc_id),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc WHERE len(w) >= 3)),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
again AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) FROM win JOIN twice USING (doc_id, g))
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
       CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       coalesce(dup.n, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
       len(w) < 50 OR 100 * coalesce(again.n, 0) > 50 * len(w) AS base_failed
FROM doc LEFT JOIN dup USING (doc_id) LEFT JOIN again USING (doc_id)"""


def test_quality_statistics_equal_sql(spark):
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed"]
    res = compare(spark, duck_connect(SF_SMALL), "op5",
                  lambda s, d: QUERIES["op5_quality_rules"](s, d).select(*base),
                  BASE_STATS, SF_SMALL)
    assert res["schema_match"] and res["value_match"], res
