"""Context vectors, pooling and scores of the quality classifier against plain versions, from given weights."""

import random

import numpy as np
import pytest
from lectern.llm import quality_classifier as qc


def texts():
    rng = random.Random(2)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["UPPER", "12", "a-b", "!!!", "Straße"]
    return [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 2, 3, 50, 400, 3000)] + [None]


def pieces_in(text):
    return [p for w in (text or "").split() for p in qc.pieces_of(w)]


def plain_vectors(rows, pieces):
    own = dict(zip(pieces, qc.index_vectors(pieces)))
    total = {p: np.zeros(qc.DIMENSIONS) for p in pieces}
    for text in rows:
        seq = [p for p in pieces_in(text) if p in own]
        for i, p in enumerate(seq):
            for d in (-2, -1, 1, 2):
                if 0 <= i + d < len(seq):
                    total[p] += own[seq[i + d]]
    return np.array([0.5 * total[p] / max(np.linalg.norm(total[p]), 1e-9) + own[p] / np.sqrt(qc.NONZERO) for p in pieces])


def test_context_vectors(spark):
    rows = texts()
    pieces = sorted({p for t in rows for p in pieces_in(t)})[:40]
    got = qc.context_vectors(spark.createDataFrame([(t,) for t in rows], "text string").repartition(3), pieces)
    assert got == pytest.approx(plain_vectors(rows, pieces), abs=1e-5)


def test_neighbours_across_stretches(spark):
    """One text of more pieces than a stretch: whatever lies at its seams counts."""
    rng = random.Random(3)
    names = [f"n{chr(97 + k)}" for k in range(12)]
    text = " ".join(rng.choice(names) for _ in range(qc.AT_ONCE + 50)) + " edge" + " na nb"
    long = " ".join(["x"] * (qc.AT_ONCE - 1) + ["left", "right"] + ["x"] * 5)
    pieces = [*names, "edge", "left", "right", "x"]
    got = qc.context_vectors(spark.createDataFrame([(text,), (long,)], "text string").coalesce(1), pieces)
    assert got == pytest.approx(plain_vectors([text, long], pieces), abs=1e-4)


def test_pooling_and_scores():
    import pyarrow as pa

    rows = texts()
    pieces = sorted({p for t in rows for p in pieces_in(t)})[:25]
    vectors = np.random.default_rng(1).normal(0, 1, (len(pieces), qc.DIMENSIONS)).astype(np.float32)
    got = qc.Pooling(pieces, vectors)(pa.array(rows, pa.string()))
    known = dict(zip(pieces, vectors))
    net = qc.Network()
    rng = np.random.default_rng(2)
    net.mean, net.scale, net.temperature = rng.normal(0, 1, qc.DIMENSIONS), rng.uniform(1, 2, qc.DIMENSIONS), 1.7
    net.p = {"w1": rng.normal(0, 1, (qc.DIMENSIONS, qc.HIDDEN)), "b1": rng.normal(0, 1, qc.HIDDEN), "w2": rng.normal(0, 1, qc.HIDDEN), "b2": np.array([0.3])}
    scores = net.scores(got)
    for text, x, score in zip(rows, got, scores):
        words = (text or "").split()
        long = [w for w in words if len(w.encode()) > qc.LONG]
        marks = ["<again>"] * (len(long) - len(set(long))) + ["<new>"] * len(set(long))
        every = [known[p] if p in known else qc.index_vectors([p])[0] / np.sqrt(qc.NONZERO) for p in [*pieces_in(text), *marks]]
        want = np.mean(every, axis=0) if every else np.zeros(qc.DIMENSIONS)
        assert x == pytest.approx(want, abs=1e-4)
        hidden = [np.tanh(sum((want[i] - net.mean[i]) / net.scale[i] * net.p["w1"][i, j] for i in range(qc.DIMENSIONS)) + net.p["b1"][j]) for j in range(qc.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, net.p["w2"])) + 0.3
        assert score == pytest.approx(1 / (1 + np.exp(-logit / 1.7)), abs=1e-3)
