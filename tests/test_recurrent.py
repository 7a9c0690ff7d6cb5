"""Recurrent filters: state spaces against the plain recurrence, and the scan over chunks against one serial run."""

import math

import numpy as np
import pytest
from lectern.functions import recurrent as fun
from lectern.operators import filters, recurrent
from pyspark.sql import functions as F

HUM = "highpass=f=75,lowpass=f=12000," + ",".join(f"bandreject=f={50 * h}:w={7 + h}" for h in range(1, 11))


def serial(x, sections):
    """Each section's recurrence, sample by sample."""
    for b0, b1, b2, a1, a2 in sections:
        out, x1, x2, y1, y2 = [], 0.0, 0.0, 0.0, 0.0
        for v in x:
            y = b0 * v + b1 * x1 + b2 * x2 - a1 * y1 - a2 * y2
            x1, x2, y1, y2 = v, x1, y, y1
            out.append(y)
        x = out
    return np.array(x)


def sections(chain, rate):
    return [s for s in (fun.section(n, a, rate) for n, a in fun.stages(chain)) if s]


def test_state_space():
    x = np.random.default_rng(1).uniform(-1, 1, 3000)
    for chain in ("highpass=f=70", "lowpass=f=3000", HUM, "bandreject=f=50:w=8:t=h"):
        space = fun.compiled(chain, 48000)
        y, state = space.run(x, np.zeros(space.size))
        assert y == pytest.approx(serial(x, sections(chain, 48000)), abs=1e-11)
        one, s = space.run(x[:1001], np.zeros(space.size))
        two, s = space.run(x[1001:], s)
        assert np.r_[one, two] == pytest.approx(y, abs=1e-11) and s == pytest.approx(state, abs=1e-11)


def test_weighting_is_that_of_48_khz():
    """The published coefficients of the measure at 48 kHz."""
    shelf, high = fun.weighting(48000)
    assert shelf == pytest.approx((1.53512485958697, -2.69169618940638, 1.19839281085285, -1.69065929318241, 0.73248077421585), abs=1e-9)
    assert high == pytest.approx((1.0, -2.0, 1.0, -1.99004745483398, 0.99007225036621), abs=1e-9)


def test_gains():
    t = np.arange(48000) / 48000

    def gain(chain, f):
        space = fun.compiled(chain, 48000)
        return np.abs(space.run(np.sin(2 * math.pi * f * t), np.zeros(space.size))[0][24000:]).max()

    assert gain("highpass=f=70", 70) == pytest.approx(0.707, abs=0.01) and gain("highpass=f=70", 7) < 0.02 and gain("highpass=f=70", 5000) == pytest.approx(1, abs=0.01)
    assert gain("lowpass=f=1000", 10000) < 0.02 and gain("bandreject=f=50:w=8", 50) < 0.01 and gain("bandreject=f=50:w=8", 1000) == pytest.approx(1, abs=0.01)
    with pytest.raises(ValueError):
        fun.compiled("echo=f=3", 48000)


def test_scan_over_chunks(spark):
    """Chunks of any size, in any order, several spans, a chain for each signal."""
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for k, chain in enumerate(("highpass=f=70", "highpass=f=75,lowpass=f=3000,bandreject=f=50:w=8,bandreject=f=100:w=9", "anull", None)):
        x, at = rng.uniform(-1, 1, 5000), 0
        want[k] = x if k > 1 else serial(x, sections(chain, 8000))
        while at < len(x):
            n = int(rng.integers(1, 700))
            rows.append((k, at, x[at : at + n].tolist(), chain))
            at += n
    rows += [(9, 0, [], "anull")]
    df = spark.createDataFrame(rows, "k long, start long, samples array<double>, chain string").repartition(7)
    got = {}
    for r in recurrent.filtered(df, ["k"], 8000, F.col("chain"), span=1024).collect():
        got.setdefault(r.k, {})[r.start] = r.samples
    assert set(got) == {0, 1, 2, 3}
    for k, parts in got.items():
        assert np.concatenate([parts[s] for s in sorted(parts)]) == pytest.approx(want[k], abs=1e-10)


def as_sql_says(x, sections):
    """Each section's recurrence with two numbers of memory, in the order of operations of the queries' SQL."""
    for b0, b1, b2, a1, a2 in sections:
        out, p, q = [], 0.0, 0.0
        for v in x:
            y = b0 * v + p
            p, q = b1 * v - a1 * y + q, b2 * v - a2 * y
            out.append(y)
        x = out
    return [float(v) for v in x]


def test_short_signals_are_the_plain_recurrence_to_the_last_digit(spark):
    """Chunks of any size, signals of several lengths and chains in a task, one of them without a key; a lane begins from the
    state behind the one before."""
    rng, rate = np.random.default_rng(5), 48000
    made = {k: (rng.uniform(-1, 1, n), c) for k, n, c in ((1, 256, HUM), (2, 128, HUM), (3, 256, "highpass=f=70"), (4, 1, HUM), (5, 97, "lowpass=f=30000"), (None, 300, HUM))}
    rows = [(k, a, x[a : a + 96].tolist(), c) for k, (x, c) in made.items() for a in range(0, len(x), 96)]
    df = spark.createDataFrame(rows, "k long, start long, samples array<double>, chain string").repartition(3)
    for lane in (1 << 16, 64):
        got = {}
        for r in recurrent.filtered(df, ["k"], rate, F.col("chain"), span=128, lane=lane).collect():
            got.setdefault(r.k, {})[r.start] = r.samples
        assert set(got) == set(made)
        for k, (x, c) in made.items():
            y, want = np.concatenate([got[k][a] for a in sorted(got[k])]), as_sql_says(x, sections(c, rate))
            assert y.tolist() == want if lane > 300 else y == pytest.approx(want, abs=1e-10)


def test_a_long_signal_through_the_chain_of_a_profile(spark):
    """Ten million samples through the chain that pre_clean builds, without its last stage, against one run over all."""
    n, size = 10_000_000, 1 << 16
    tone = F.transform(F.sequence(F.col("start"), F.least(F.col("start") + size, F.lit(n)) - 1), lambda i: F.sin(i * 0.01) + F.sin(i * i * 1e-9))
    chunks = spark.range(0, n, size, 16).select(F.lit(1).alias("k"), F.col("id").alias("start")).select("k", "start", tone.alias("samples"))
    chain = spark.range(1).select(filters.pre_clean(F.lit("hum"), F.lit(50), F.lit(True), F.lit("")).alias("c")).first().c
    chain = ",".join(p for p in chain.split(",") if not p.startswith("afftdn"))
    sums = recurrent.filtered(chunks, ["k"], 48000, chain, span=1 << 20).select("start", F.get("samples", F.size("samples") - 1).alias("last"), F.get("samples", F.lit(100)).alias("some")).orderBy("start").collect()
    i = np.arange(n, dtype=np.float64)
    space = fun.compiled(chain, 48000)
    y, _ = space.run(np.sin(i * 0.01) + np.sin(i * i * 1e-9), np.zeros(space.size))
    for r in sums:
        end = min(r.start + size, n) - 1
        assert r.last == pytest.approx(y[end], abs=1e-9) and r.some == pytest.approx(y[r.start + 100], abs=1e-9)
