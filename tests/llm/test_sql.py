"""Queries of this subpackage against their SQL in DuckDB."""

from collections import Counter

import duckdb
import pytest
from lectern.llm import queries


@pytest.mark.parametrize("name", ["op6b_base_secrets", "op8b_mixing_targets", "op9b_base_personal_data", "op10b_certified_rules"])
def test_same_rows(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(*want.columns).collect()
    assert Counter(map(tuple, rows)) == Counter(want.fetchall())
    if name == "op10b_certified_rules":
        assert any(not r.kept and not r.base_failed for r in rows)


def test_all_sql_has_a_query():
    assert set(queries.oracle_sql()) <= set(queries.queries())
