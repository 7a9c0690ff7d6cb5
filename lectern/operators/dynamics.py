"""A peak limiter over chunk rows of signals of any length: never above its limit, with a smooth gain."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .signal import mapped, tiled

#: Fixed value: what the limiter lets through at most. Seconds on either side over which its gain moves.
LIMIT, ATTACK = 0.95, 0.005
TILE = 1 << 16


def sliding_least(x, reach: int):
    """Of each element and reach on either side the smallest, by least values from the left and from the right of blocks."""
    import numpy as np

    width = 2 * reach + 1
    padded = np.full(-(-(len(x) + 2 * reach) // width) * width, np.inf)
    padded[reach : reach + len(x)] = x
    by_block = padded.reshape(-1, width)
    forward = np.minimum.accumulate(by_block, axis=1).ravel()
    backward = np.minimum.accumulate(by_block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: len(x)], forward[width - 1 : width - 1 + len(x)])


def limited(chunks: DataFrame, keys: list[str], rate: float, limit: float = LIMIT, attack: float = ATTACK, tile: int = TILE, cut: bool = True) -> DataFrame:
    """(keys, start, samples): each sample times the mean, over attack seconds on either side, of the least gains there.

    The gain that a sample needs is limit / |x|, or 1; the least of these within reach is at most what each of them needs, and
    so is a mean of such, so nothing passes the limit. Where nothing within two reaches is above it, samples stay as they are.
    Beyond the ends of a signal the gain is 1. A tile takes two reaches of samples on both sides. The mean adds from the left to
    the right, so results are to the last digit what the plain formula gives; a mean of many equal gains may come out a last
    digit above them, and what that puts above the limit is cut to it, unless cut is false.
    """
    import numpy as np

    reach = max(1, round(attack * rate))

    def made(x, number, at, core):
        size = np.abs(x)
        need = np.ones(len(x) + 2 * reach)
        need[reach : reach + len(x)] = np.where(size > limit, limit / np.where(size > limit, size, 1.0), 1.0)
        least = sliding_least(need, reach)
        windows = np.lib.stride_tricks.sliding_window_view(least[at : at + core + 2 * reach], 2 * reach + 1)
        total, own = np.zeros(core), x[at : at + core]
        for gains in windows.T:
            total += gains
        y = own * (total / (2 * reach + 1))
        return number * tile, np.where(windows.min(axis=1) < 1.0, np.clip(y, -limit, limit) if cut else y, own)

    return mapped(tiled(chunks, keys, tile, 2 * reach, 2 * reach), keys, tile, made)
