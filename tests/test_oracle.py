"""Every registered query of the reference's operators against its DuckDB oracle (sf0.01)."""
import pytest

import __spark_entry__ as E
from cabwise.queries import ORACLE_SQL as ORACLE, QUERIES
from tables import SF_CHECK
from oracle_harness import compare


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) and len(QUERIES) == 52
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, key):
    r = compare(spark, SF_CHECK, key, QUERIES[key], ORACLE[key])
    assert r["cols_match"], r
    assert r["types_match"], r.get("types")
    assert r["rows_spark"] == r["rows_oracle"] > 0, r
    assert r["hash_match"], r.get("diff")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 24
    assert df.columns == ["hour", "longitude", "latitude"]
