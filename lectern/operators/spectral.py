"""Noise reduction in the short-time spectrum, over chunk rows of signals of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .signal import mapped, tiled

#: Samples of a frame, frames that lie over each sample, frames of a tile.
FRAME, OVERLAP, FRAMES = 1024, 4, 256


def denoised(chunks: DataFrame, keys: list[str], reduction: float, floor: float, frame: int = FRAME, frames: int = FRAMES) -> DataFrame:
    """(keys, start, samples): in each frame's spectrum, bins are turned down by at most reduction decibels as they come near
    a noise floor (decibels below a sine at full scale).

    Frames begin at multiples of a quarter of their length, wherever chunks are cut, under a root of a Hann window before and
    after; what overlaps is added, so without a reduction the signal comes back. A bin of power p has the gain of
    sqrt(1 - noise / p), or the most that it may lose. Before and behind a signal is silence.
    """
    import numpy as np

    hop = frame // OVERLAP
    size = frames * hop
    window = np.sin(np.pi * (np.arange(frame) + 0.5) / frame)
    whole = (window**2).reshape(OVERLAP, hop).sum(axis=0)  # what all frames over a sample add up to
    least = 10 ** (-reduction / 20)
    # A sine at full scale has half the sum of the window as its largest bin; noise spreads over bins as the window's energy.
    noise = 10 ** (floor / 10) * (window.sum() / 2) ** 2

    def made(x, number, at, core):
        padded = np.zeros(size + 2 * frame)
        padded[frame - at : frame - at + len(x)] = x
        parts = np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop] * window
        spectrum = np.fft.rfft(parts, axis=1)
        power = np.abs(spectrum) ** 2
        kept = np.sqrt(np.maximum(0.0, 1.0 - noise / np.maximum(power, 1e-300)))
        parts = np.fft.irfft(spectrum * np.maximum(kept, least), n=frame, axis=1) * window
        out = np.zeros(len(padded))
        for k in range(OVERLAP):  # frames that do not lie over each other at once
            own = parts[k::OVERLAP]
            out[k * hop : k * hop + own.size] += own.ravel()
        return number * size, out[frame : frame + core] / np.tile(whole, -(-core // hop))[:core]

    return mapped(tiled(chunks, keys, size, frame, frame), keys, size, made)
