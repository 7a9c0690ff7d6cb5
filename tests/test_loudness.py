"""Tiles, resampling by a windowed sinc, and gated loudness, against plain versions over whole signals."""

import math

import numpy as np
import pytest
from lectern.functions import recurrent as fun
from lectern.operators import loudness, resampling, signal


def cut(spark, signals, size, rng=None):
    """Chunk rows of so many samples, or of random sizes."""
    rows = []
    for k, x in signals.items():
        at = 0
        while at < len(x):
            n = size if rng is None else int(rng.integers(1, size))
            rows.append((k, at, [float(v) for v in x[at : at + n]]))
            at += n
    return spark.createDataFrame(rows, "k long, start long, samples array<double>").repartition(5)


def joined(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.k, {})[r.start] = r.samples
    out = {}
    for k, parts in got.items():
        at = 0
        for s in sorted(parts):
            assert s == at
            at += len(parts[s])
        out[k] = np.concatenate([parts[s] for s in sorted(parts)])
    return out


def test_tiles(spark):
    x = {1: np.arange(100.0), 2: np.arange(1.0), 3: np.arange(10.0)}
    for size, before, after in ((10, 3, 25), (7, 0, 0), (64, 5, 5)):
        got = {(r.k, r.tile): (r.start, r.samples) for r in signal.tiled(cut(spark, x, 9, np.random.default_rng(1)), ["k"], size, before, after).collect()}
        assert set(got) == {(k, t) for k, v in x.items() for t in range(-(-len(v) // size))}
        for (k, t), (start, samples) in got.items():
            low = max(0, t * size - before)
            assert start == low and samples == list(x[k][low : (t + 1) * size + after])


def plain_sinc(x, old, new, method):
    """The sum over all samples, for each point."""
    crossings, kept, beta = resampling.KERNELS[method]
    g = math.gcd(old, new)
    old, new = old // g, new // g
    band, out = min(old, new) * kept, []
    for m in range(-(-len(x) * new // old)):
        total = 0.0
        for k, v in enumerate(x):
            t = (k / old - m / new) * band
            if abs(t) < crossings:
                w = math.cos(t * math.pi / crossings / 2) ** 2 if beta is None else np.i0(beta * math.sqrt(1 - (t / crossings) ** 2)) / np.i0(beta)
                total += v * np.sinc(t) * w * band / old
        out.append(total)
    return out


@pytest.mark.parametrize("old,new,method", [(48000, 16000, "sinc_fast"), (44100, 48000, "kaiser_fast"), (16000, 48000, "kaiser_best"), (8000, 12000, "sinc_best")])
def test_sinc(spark, old, new, method):
    rng = np.random.default_rng(3)
    x = {1: rng.uniform(-1, 1, 700), 2: rng.uniform(-1, 1, 1), 3: rng.uniform(-1, 1, 150)}
    want = {k: plain_sinc(v, old, new, method) for k, v in x.items()}
    for size, tile in ((7, 100), (65536, 1 << 16)):
        got = joined(resampling.sinc_resampled(cut(spark, x, size), ["k"], old, new, method, tile))
        assert set(got) == set(x)
        for k in x:
            assert got[k] == pytest.approx(want[k], abs=1e-10)


def test_methods_differ_and_names_are_checked(spark):
    x = {1: np.random.default_rng(4).uniform(-1, 1, 300)}
    found = [joined(resampling.sinc_resampled(cut(spark, x, 50), ["k"], 48000, 16000, m))[1] for m in ("sinc_fast", "kaiser_fast", "kaiser_best")]
    assert all(np.abs(a - b).max() > 1e-3 for a, b in ((found[0], found[1]), (found[1], found[2])))
    with pytest.raises(ValueError):
        resampling.kernel(3, 1, "nearest")
    assert joined(resampling.sinc_resampled(cut(spark, x, 50), ["k"], 48000, 48000))[1] == pytest.approx(x[1])


def plain_loudness(x, rate, long):
    y = np.array(x)
    for b0, b1, b2, a1, a2 in fun.weighting(rate):
        out, s1, s2 = [], 0.0, 0.0
        for v in y:
            o = b0 * v + s1
            s1, s2 = b1 * v - a1 * o + s2, b2 * v - a2 * o
            out.append(o)
        y = np.array(out)

    def powers(n):
        size, hop = n * rate // 10, rate // 10
        return np.array([np.mean(y[a : a + size] ** 2) for a in range(0, len(y) - size + 1, hop)])

    def gated(p, relative):
        p = p[p > 0]
        p = p[-0.691 + 10 * np.log10(p) > -70]
        if len(p):
            p = p[-0.691 + 10 * np.log10(p) > -0.691 + 10 * np.log10(p.mean()) + relative]
        return p

    p, q = gated(powers(4), -10), gated(powers(long), -20)
    lu = np.round(100 * (-0.691 + 10 * np.log10(q))) / 100
    return -0.691 + 10 * np.log10(p.mean()) if len(p) else None, np.quantile(lu, 0.95) - np.quantile(lu, 0.1) if len(q) else None


def test_loudness(spark):
    rng, rate, long = np.random.default_rng(5), 4000, 8
    level = np.repeat(10.0 ** rng.uniform(-4, 0, 30), 500)
    x = {1: rng.uniform(-1, 1, 15000) * level, 2: np.zeros(9000), 3: rng.uniform(-1, 1, 800), 4: np.sin(np.arange(8123) * 0.7), 5: rng.uniform(-1, 1, 6000) * 1e-7}
    df = cut(spark, x, 900, rng)
    got = {r.k: r for r in loudness.loudness(df, ["k"], rate, long=long).collect()}
    assert set(got) == set(x)
    for k, v in x.items():
        integrated, spread = plain_loudness(v, rate, long)
        assert got[k].integrated == (None if integrated is None else pytest.approx(integrated, abs=1e-8))
        assert got[k].range == (None if spread is None else pytest.approx(spread, abs=1e-8))
        above = np.abs(plain_sinc(v[:2000], 1, 4, "sinc_fast")).max() if len(v) <= 2000 else None
        if above:
            assert got[k].true_peak == pytest.approx(20 * math.log10(above), abs=1e-9)
    assert got[2].true_peak is None and got[2].integrated is None and got[5].integrated is None and got[1].range > 3


def test_loudness_of_a_tone(spark):
    """Of 997 Hz at full scale on one channel: -3.01 LU; the true peak of a tone at a quarter of the rate lies between samples."""
    rate = 48000
    t = np.arange(rate * 2)
    x = {1: np.sin(2 * math.pi * 997 * t / rate), 2: np.sin(math.pi / 2 * t + math.pi / 4)}
    df = cut(spark, x, 10007)
    got = {r.k: r for r in loudness.loudness(df, ["k"], rate).collect()}
    assert got[1].integrated == pytest.approx(-3.01, abs=0.02) and got[1].range is None
    assert np.abs(x[2]).max() < 0.71 and got[2].true_peak == pytest.approx(0.0, abs=0.3)
    new = joined(loudness.normalised(df, ["k"], rate, -24.0, -3.0))
    again = {r.k: r for r in loudness.loudness(cut(spark, new, 10007), ["k"], rate).collect()}
    assert again[1].integrated == pytest.approx(-24.0, abs=1e-6)
    limited = joined(loudness.normalised(df, ["k"], rate, 10.0, -6.0))
    assert 20 * math.log10(np.abs(limited[1]).max()) == pytest.approx(-6.0, abs=0.1)
