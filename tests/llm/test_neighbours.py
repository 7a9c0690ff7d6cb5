"""Nearest vectors against brute force: recall, exact scores, copies, ties, odd rows."""

import numpy as np
import pytest
from lectern.llm import neighbours

KIND = "vec_id long, embedding array<float>"


def brute(ids, x, every=50, nearest=5):
    x = np.asarray(x, dtype=np.float32).astype(np.float64)
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    out = {}
    for q in np.nonzero(ids % every == 0)[0]:
        score = u @ u[q]
        order = [i for i in np.lexsort((ids, -np.round(score, 12))) if i != q][:nearest]
        out.setdefault(int(ids[q]), []).append([(int(ids[i]), score[i]) for i in order])
    return out


def found(df, **more):
    out = {}
    for r in neighbours.nearest_rows(df, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), None if v is None else [None if c is None else float(c) for c in v]) for i, v in zip(ids, x)], KIND).repartition(6)


@pytest.mark.parametrize("split", [1 << 14, 20])
def test_recall_and_scores(spark, split):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (3000, 64))
    x[1000:1400] = x[7] + rng.normal(0, 0.05, (400, 64))  # a large group of near copies
    x[1400:2000] = x[50]  # exact copies of a query
    ids = rng.permutation(3000)
    want, got = brute(ids, x), found(table(spark, ids, x), split=split)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = total = 0
    u = {int(i): v.astype(np.float32).astype(np.float64) for i, v in zip(ids, x)}
    for q, rows in got.items():
        for i, score in rows:
            assert score == pytest.approx(u[q] @ u[i] / np.sqrt((u[q] @ u[q]) * (u[i] @ u[i])), abs=1e-12) and i != q
        assert [(-round(s, 12), i) for i, s in rows] == sorted((-round(s, 12), i) for i, s in rows)
        least = want[q][0][-1][1]
        hits += sum(s >= least - 1e-12 for _, s in rows)
        total += 5
    assert hits / total >= 0.93
    copies = sorted(int(i) for i in ids[1400:2000])
    for q in [i for i in copies if i % 50 == 0]:
        assert [i for i, _ in got[q]] == [i for i in sorted([*copies, int(ids[50])]) if i != q][:5]


def test_few_odd_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [1, 0.1]), (2, [0, 0]), (3, None), (4, [nan, 1]), (5, [inf, 1]), (6, [None, 1]), (7, []), (8, [0.5]), (50, [1e-30, 0]), (50, [1e-30, 0]), (100, [-1, 0, 0])]
    got = {}
    df = table(spark, *zip(*rows)).unionByName(spark.createDataFrame([(None, [1.0, 1.0])], KIND))
    for r in neighbours.nearest_rows(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 6)))
    assert sorted(got) == [0, 50, 100]
    assert sorted(got[0]) == [(1, 8, 1.0), (2, 50, 1.0), (3, 50, 1.0), (4, 1, 0.995037), (5, 100, -1.0)]
    assert sorted(got[50]) == sorted(2 * [(1, 0, 1.0), (2, 8, 1.0), (3, 50, 1.0), (4, 1, 0.995037), (5, 100, -1.0)])
    assert [s for _, _, s in sorted(got[100])] == [-0.995037, -1.0, -1.0, -1.0, -1.0]


def test_none_and_clashing_names(spark):
    assert neighbours.nearest_rows(spark.createDataFrame([], KIND)).collect() == []
    one = spark.createDataFrame([(0, [1.0], 5, "x")], "vec_id long, embedding array<float>, rank int, score string")
    assert neighbours.nearest_rows(one).collect() == []
    assert neighbours.nearest_rows(spark.createDataFrame([(7, [1.0]), (8, [1.0])], KIND)).collect() == []
