"""Every query of the library against its SQL in DuckDB."""

from collections import Counter

import duckdb
import pytest
from lectern.plans.oracle import SQL
from lectern.plans.queries import QUERIES
from lectern.sources.files import TABLES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_all_have_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    want = duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = Counter(tuple(r[c] for c in columns) for r in got.collect())
    order = [want.columns.index(c) for c in columns]
    expected = Counter(tuple(r[k] for k in order) for r in want.fetchall())
    extra, missing = rows - expected, expected - rows
    assert not extra and not missing, (list(extra)[:3], list(missing)[:3], len(rows), len(expected))
    assert rows


def test_a_null_vector_does_not_take_its_signal_along(spark, sf, tmp_path):
    """Vector 7 is null, and so are all of signal 3: the others of signal 1 remain."""
    path = f"{tmp_path}/embeddings.parquet"
    con = duckdb.connect()
    con.sql(f"COPY (SELECT * REPLACE (CASE WHEN vec_id = 7 OR vec_id // 4 = 3 THEN NULL ELSE embedding END AS embedding) FROM '{sf}/embeddings.parquet' WHERE vec_id < 20) TO '{path}' (FORMAT parquet)")
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    for name in ("q49_chain_samples", "q43_limited_samples"):
        got = QUERIES[name](spark, str(tmp_path))
        want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]})").fetchall()
        assert Counter(map(tuple, got.collect())) == Counter(want) and len(want) == 4 * 256 - 64
