"""The limiter, noise reduction, speech segments and cuts at keyframes, against plain versions over whole signals."""

import math
import random

import numpy as np
import pytest
from lectern.operators import chains, dynamics, loudness, recurrent, segments, spectral, speech

from tests.test_loudness import cut, joined
from tests.test_recurrent import as_sql_says, sections


@pytest.mark.parametrize("size,tile", [(7, 50), (900, 1 << 16)])
def test_limiter(spark, size, tile):
    rng, reach, limit = np.random.default_rng(1), 12, 0.95
    x = {1: rng.normal(0, 0.5, 1500), 2: np.full(30, 3.0), 3: rng.uniform(-0.9, 0.9, 200), 4: np.array([-5.0]), 5: np.where(np.arange(400) == 200, 8.0, 0.5)}
    got = joined(dynamics.limited(cut(spark, x, size, rng), ["k"], 1000, limit, 0.012, tile))
    assert set(got) == set(x)
    for k, v in x.items():
        need = np.r_[np.ones(2 * reach), np.minimum(1, limit / np.maximum(np.abs(v), 1e-9)), np.ones(2 * reach)]
        least = np.array([need[max(0, i - reach) : i + reach + 1].min() for i in range(len(need))])
        gain = np.array([least[i + reach : i + 3 * reach + 1].mean() for i in range(len(v))])
        assert got[k] == pytest.approx(v * gain, abs=1e-9) and np.abs(got[k]).max() <= limit
    assert got[3].tolist() == x[3].tolist() and np.abs(got[5][:100]).tolist() == [0.5] * 100


def test_limiter_to_the_last_digits(spark):
    """Within a plateau the gain is limit / peak and nothing less, so that millionths come out as by the plain formula."""
    x = np.full(61, 2.0)
    x[30] = (400_000.5 + 1e-7) / 475_000
    got = joined(dynamics.limited(cut(spark, {1: x}, 25), ["k"], 1000, 0.95, 0.012))[1]
    assert np.rint(got[30] * 1e6) == 400_001
    assert got[24:37] == pytest.approx(x[24:37] * 0.475, rel=1e-15, abs=0) and np.abs(got).max() <= 0.95


def test_sliding_least():
    rng = np.random.default_rng(2)
    for n, reach in ((1, 1), (5, 3), (100, 7), (64, 0)):
        x = rng.uniform(0, 1, n)
        assert dynamics.sliding_least(x, reach).tolist() == [x[max(0, i - reach) : i + reach + 1].min() for i in range(n)]


def test_noise_reduction(spark):
    rng = np.random.default_rng(3)
    t = np.arange(20000)
    tone, noise = 0.5 * np.sin(t * 0.2), rng.normal(0, 0.01, len(t))
    x = {1: tone + noise, 2: rng.uniform(-1, 1, 1), 3: rng.uniform(-1, 1, 1025), 4: noise}
    df = cut(spark, x, 777, rng)
    same = joined(spectral.denoised(df, ["k"], 0.0, -30.0))
    assert set(same) == set(x) and all(same[k] == pytest.approx(x[k], abs=1e-9) for k in x)
    clean = joined(spectral.denoised(df, ["k"], 12.0, -45.0))
    inner = slice(1024, -1024)
    left, was = np.mean((clean[1] - tone)[inner] ** 2), np.mean(noise[inner] ** 2)
    assert 10 * np.log10(was / left) > 6 and np.mean(clean[4] ** 2) < 0.12 * np.mean(noise**2)
    tiles = joined(spectral.denoised(cut(spark, x, 64), ["k"], 12.0, -45.0, frames=8))
    assert all(tiles[k] == pytest.approx(clean[k], abs=1e-9) for k in x)


def plain_speech(x, frame, on, off, pause, least):
    v = np.rint(np.clip(x, -1, 1) * 32767).astype(int)
    speaking, runs = False, []
    for f in range(-(-len(v) // frame)):
        part = v[f * frame : (f + 1) * frame]
        e, n = int((part.astype(object) ** 2).sum()), len(part)
        speaking = True if e >= on * n else False if e < off * n else speaking
        if speaking:
            if runs and f - runs[-1][1] - 1 <= pause:
                runs[-1] = (runs[-1][0], f, runs[-1][2] + e)
            else:
                runs.append((f, f, e))
    return [r for r in runs if r[1] - r[0] + 1 >= least]


def test_speech(spark):
    rng = np.random.default_rng(4)
    x = {k: rng.normal(0, 1, 4000) * np.repeat(rng.choice([0.0, 0.02, 0.1, 0.4], 80), 50) for k in range(6)}
    x |= {6: np.zeros(300), 7: np.full(20, 0.5), 8: np.full(33, 0.1)}
    on, off = 4_000_000, 800_000
    for frame, pause, least in ((40, 2, 3), (33, 0, 1)):
        for size in (11, 5000):
            found = speech.speech_segments(cut(spark, x, size, rng), ["k"], frame, on, off, pause, least).collect()
            got = {k: sorted((r["first"], r["last"], r["energy"]) for r in found if r.k == k) for k in x}
            assert got == {k: plain_speech(v, frame, on, off, pause, least) for k, v in x.items()} and len(found) > 5


def test_keyframes(spark):
    rng = random.Random(5)
    frames = {k: sorted(rng.sample(range(100), rng.randint(0, 9))) for k in range(30)}
    durations = {k: rng.randint(0, 100) for k in frames}
    df = spark.createDataFrame([(k, d) for k, d in durations.items()], "k long, duration long")
    keys = spark.createDataFrame([(k, f) for k, v in frames.items() for f in v], "k long, at long")
    got = {}
    for r in segments.keyframe_chunks(df, keys, "k", 20).orderBy("k", "idx").collect():
        got.setdefault(r.k, []).append((r.idx, r.start, r.stop))
    for k, d in durations.items():
        starts = [0] if d else []
        for t in range(20, d, 20):
            after = [f for f in frames[k] if f >= t]
            if after and after[0] < d and after[0] not in starts:
                starts.append(after[0])
        assert got.get(k, []) == [(i, a, b) for i, (a, b) in enumerate(zip(starts, starts[1:] + [d]))]


def test_a_chain_to_the_last_digits(spark):
    """The chain of q49, by plain formulas: filters before and after a limiter, with no more than errors of the last digits."""
    rng, rate, limit, reach = np.random.default_rng(8), 1000, 0.5, 5
    x = {k: rng.normal(0, 0.6, n) for k, n in ((1, 256), (2, 128))}
    got = joined(chains.applied(cut(spark, x, 96), ["k"], rate, "highpass=f=70,lowpass=f=300,alimiter=limit=0.5,anull,bandreject=f=50:w=8"))
    assert set(got) == set(x)
    for k, v in x.items():
        v = np.array(as_sql_says(v, sections("highpass=f=70,lowpass=f=300", rate)))
        need = np.r_[np.ones(2 * reach), np.minimum(1, limit / np.abs(v)), np.ones(2 * reach)]
        least = np.array([need[i : i + 2 * reach + 1].min() for i in range(len(v) + 2 * reach)])
        v = v * np.array([math.fsum(least[i : i + 2 * reach + 1]) / (2 * reach + 1) for i in range(len(v))])
        assert got[k] == pytest.approx(np.array(as_sql_says(v, sections("bandreject=f=50:w=8", rate))), rel=0, abs=1e-14)


def test_a_chain_to_the_last_bit(spark):
    """Equal to the arithmetic of the SQL of q49: means of gains from the left, no cut between stages, notches divided by a0."""
    rng, rate, limit, reach = np.random.default_rng(9), 1000, 0.5, 5
    x = {k: v for k, v in enumerate((rng.normal(0, 0.6, 256), rng.normal(0, 0.6, 128), rng.normal(0, 3, 1), np.zeros(70), np.full(300, 2.0), rng.normal(0, 0.01, 200)))}
    got = joined(chains.applied(cut(spark, x, 96), ["k"], rate, "highpass=f=70,lowpass=f=300,alimiter=limit=0.5,anull,bandreject=f=50:w=8"))
    assert set(got) == set(x)
    c, al = math.cos(2 * math.pi * 50 / rate), math.sin(2 * math.pi * 50 / rate) / 16
    over = 0
    for k, v in x.items():
        v = as_sql_says(v, sections("highpass=f=70,lowpass=f=300", rate))
        need = [1.0] * 2 * reach + [limit / abs(s) if abs(s) > limit else 1.0 for s in v] + [1.0] * 2 * reach
        least, want, p, q = [min(need[i : i + 2 * reach + 1]) for i in range(len(v) + 2 * reach)], [], 0.0, 0.0
        for i, s in enumerate(v):
            gain = 0.0
            for g in least[i : i + 2 * reach + 1]:
                gain += g
            s = s * (gain / (2 * reach + 1))
            over += abs(s) > limit
            y = s / (1 + al) + p
            p, q = -2 * c / (1 + al) * s + 2 * c / (1 + al) * y + q, s / (1 + al) - (1 - al) / (1 + al) * y
            want.append(y)
        assert got[k].tolist() == want
    assert over


def test_a_chain_that_ends_in_a_limiter_keeps_its_limit(spark):
    """Also where what follows has no effect, at 11 gains whose mean comes out above them."""
    x = {1: np.random.default_rng(9).normal(0, 2, 4000)}
    for rest in ("", ",anull", ",lowpass=f=600"):
        assert np.abs(joined(chains.applied(cut(spark, x, 500), ["k"], 1000, "lowpass=f=300,alimiter=limit=0.5" + rest))[1]).max() <= 0.5


def test_chains_are_their_stages_one_after_the_other(spark):
    rng = np.random.default_rng(6)
    x = {1: rng.normal(0, 0.3, 24000) + np.sin(np.arange(24000) * 0.01), 2: rng.normal(0, 0.01, 9000)}
    df, rate = cut(spark, x, 3000, rng), 16000
    for chain in (chains.SAFE, chains.POST, chains.OLDER_POST, "anull", "lowpass=f=3000,alimiter"):
        want = df
        for part in chain.split(","):
            if part.startswith(("highpass", "lowpass")):
                want = recurrent.filtered(want, ["k"], rate, part)
            elif part.startswith("afftdn"):
                want = spectral.denoised(want, ["k"], 6.0, -35.0)
            elif part.startswith("loudnorm"):
                want = loudness.normalised(want, ["k"], rate, *((-16.0, -1.5) if "-16" in part else (-24.0, -3.0)))
            elif part.startswith("alimiter"):
                want = dynamics.limited(want, ["k"], rate)
        got, want = joined(chains.applied(df, ["k"], rate, chain)), joined(want)
        assert set(got) == set(want) == set(x) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in x)
    with pytest.raises(ValueError):
        chains.applied(df, ["k"], rate, "highpass=f=70,echo=1")
