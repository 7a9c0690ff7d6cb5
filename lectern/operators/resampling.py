"""Resampling by a windowed sinc, over chunk rows of signals of any length."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.signal import downmix

from .signal import mapped, tiled

#: Zero crossings on each side, share of the band that is kept, and the shape of a Kaiser window (none: Hann).
KERNELS = {
    "sinc_fast": (16, 0.99, None),
    "sinc_best": (64, 0.99, None),
    "kaiser_fast": (16, 0.85, 8.555504641634386),
    "kaiser_best": (64, 0.9475937167399596, 14.769656459379492),
}
#: Samples of a tile, before halos.
TILE = 1 << 16


def kernel(old: int, new: int, method: str):
    """(halo, weights[phase, sample]) for rates without a common divisor: phase p of new, from sample -halo on."""
    import numpy as np

    if method not in KERNELS:
        raise ValueError(f"method must be one of {', '.join(KERNELS)}: {method}")
    crossings, kept, beta = KERNELS[method]
    band = min(old, new) * kept
    halo = math.ceil(crossings * old / band)
    t = (np.arange(-halo, halo + old)[None, :] / old - np.arange(new)[:, None] / new) * band
    t = np.clip(t, -crossings, crossings)
    window = np.cos(t * math.pi / crossings / 2) ** 2 if beta is None else np.i0(beta * np.sqrt(1 - (t / crossings) ** 2)) / np.i0(beta)
    return halo, np.sinc(t) * window * band / old


def sinc_resampled(chunks: DataFrame, keys: list[str], old_rate: int, new_rate: int, method: str = "sinc_fast", tile: int = TILE) -> DataFrame:
    """(keys, start, samples) at the new rate: sample m lies at m * old / new; before and behind a signal is silence.

    A signal of n samples has ceil(n * new / old). Each tile takes the samples that its kernel reaches on both sides, over as
    many chunks as that takes. Equal rates change nothing.
    """
    import numpy as np

    common = math.gcd(old_rate, new_rate)
    old, new = old_rate // common, new_rate // common
    if old == new:
        return chunks.select(*keys, "start", "samples")
    halo, weights = kernel(old, new, method)
    blocks = max(1, tile // old)
    size = blocks * old

    def made(x, number, at, core):
        padded = np.zeros(size + 2 * halo)
        padded[halo - at : halo - at + len(x)] = x
        n = -(-core // old)
        windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * halo + old)[: n * old : old]
        return number * blocks * new, (windows @ weights.T).ravel()[: -(-core * new // old)]

    return mapped(tiled(chunks, keys, size, halo, halo), keys, size, made)


def converted(stereo: DataFrame, keys: list[str], left: str, right: str, old_rate: int, new_rate: int = 48000, method: str = "sinc_fast") -> DataFrame:
    """(keys, start, samples): the audio that is worked on, from chunk rows (keys, start, left, right): one channel, at one rate."""
    mono = stereo.select(*keys, F.col("start").cast("bigint").alias("start"), downmix(F.col(left), F.col(right)).alias("samples"))
    return sinc_resampled(mono, keys, old_rate, new_rate, method)
