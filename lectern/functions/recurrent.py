"""Linear filters with memory: chains of second-order sections as one state space, run over a block of samples.

Everything here is arithmetic on small arrays; operators.recurrent shares the work among tasks.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

#: Samples that one matrix product makes.
BLOCK = 128
#: What a filter is called, and its width where none is given (a quality, 1 / sqrt 2 for passes).
PASSES, REJECT, BUTTERWORTH, REJECT_QUALITY = {"highpass": 1, "lowpass": -1}, "bandreject", 0.707, 0.5


def unscaled(name: str, args: dict[str, str], rate: float) -> tuple[tuple[float, ...], float, float, float] | None:
    """(b0, b1, b2), a0, a1, a2 of a filter with centre f and width w by type t (q: quality, h: hertz); None for one without effect."""
    f = float(args["f"])
    if name in PASSES and f >= rate / 2:
        if name == "lowpass":
            return None
        raise ValueError(f"{name} at {f} leaves nothing at rate {rate}")
    if f >= rate / 2:
        return None
    quality = float(args.get("w", BUTTERWORTH if name in PASSES else REJECT_QUALITY))
    if args.get("t", "q") == "h":
        quality = f / quality
    w = 2 * math.pi * f / rate
    cos, alpha = math.cos(w), math.sin(w) / (2 * quality)
    if name == REJECT:
        b = (1.0, -2 * cos, 1.0)
    else:
        s = PASSES[name]
        b = ((1 + s * cos) / 2, -s * (1 + s * cos), (1 + s * cos) / 2)
    return b, 1 + alpha, -2 * cos, 1 - alpha


def section(name: str, args: dict[str, str], rate: float) -> tuple[float, ...] | None:
    """b0, b1, b2, a1, a2 of a filter, all by a0; None for one without effect."""
    if (found := unscaled(name, args, rate)) is None:
        return None
    b, a0, a1, a2 = found
    return (*(x / a0 for x in b), a1 / a0, a2 / a0)


def weighting(rate: float) -> tuple[tuple[float, ...], ...]:
    """The two sections of the loudness weighting: a shelf for the head and a high pass, for any rate."""
    # Centre, gain in decibels and quality of the shelf, centre and quality of the high pass.
    f, gain, q = 1681.974450955533, 3.999843853973347, 0.7071752369554196
    k, v = math.tan(math.pi * f / rate), 10 ** (gain / 20)
    u = v**0.4996667741545416
    a0 = 1 + k / q + k * k
    shelf = ((v + u * k / q + k * k) / a0, 2 * (k * k - v) / a0, (v - u * k / q + k * k) / a0, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)
    f, q = 38.13547087602444, 0.5003270373238773
    k = math.tan(math.pi * f / rate)
    a0 = 1 + k / q + k * k
    return shelf, (1.0, -2.0, 1.0, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)


class StateSpace:
    """Sections one after the other: s' = A s + B x, y = C s + D x, with blocks of samples made by matrix products."""

    def __init__(self, sections: tuple[tuple[float, ...], ...], over: tuple[float | None, ...] = ()):
        self.size = n = 2 * len(sections)
        a, b, c, d = np.zeros((n, n)), np.zeros(n), np.zeros(n), 1.0
        for k, (b0, b1, b2, a1, a2) in enumerate(sections):
            # The section's input is what the sections before it give: c s + d x.
            own = np.array([[-a1, 1.0], [-a2, 0.0]])
            into = np.array([b1 - a1 * b0, b2 - a2 * b0])
            rows = slice(2 * k, 2 * k + 2)
            a[rows] += np.outer(into, c)
            a[rows, rows] += own
            b[rows] = into * d
            c, d = b0 * c, b0 * d
            c[2 * k] += 1.0
        self.a, self.b, self.c, self.d, self.powers, self.sections, self.over = a, b, c, d, {}, sections, over
        powers = [np.eye(n)]
        for _ in range(BLOCK):
            powers.append(a @ powers[-1])
        self.step = powers[BLOCK]
        self.seen = np.stack([c @ p for p in powers[:BLOCK]], axis=1)  # state to outputs
        self.kept = np.stack([powers[BLOCK - 1 - i] @ b for i in range(BLOCK)])  # inputs to state
        answer = np.r_[d, [c @ p @ b for p in powers[: BLOCK - 1]]]
        lag = np.arange(BLOCK)[None, :] - np.arange(BLOCK)[:, None]
        self.direct = np.where(lag >= 0, answer[np.maximum(lag, 0)], 0.0)  # inputs to outputs

    def power(self, n: int) -> np.ndarray:
        """What n samples of silence make of a state. Most chunks of a signal have the same length."""
        if n not in self.powers:
            if len(self.powers) >= 256:
                self.powers.clear()
            self.powers[n] = np.linalg.matrix_power(self.a, n)
        return self.powers[n]

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs, and the state behind the last sample."""
        whole = len(x) // BLOCK
        blocks = x[: whole * BLOCK].reshape(whole, BLOCK)
        pushed, states = blocks @ self.kept, np.empty((whole, self.size))
        for i in range(whole):
            states[i] = state
            state = self.step @ state + pushed[i]
        y = np.empty(len(x))
        y[: whole * BLOCK] = (blocks @ self.direct + states @ self.seen).ravel()
        for i in range(whole * BLOCK, len(x)):
            y[i] = self.c @ state + self.d * x[i]
            state = self.a @ state + self.b * x[i]
        return y, state


#: Samples that lanes run side by side hold together.
SIDE_BY_SIDE = 1 << 22


def plain(sections: tuple[tuple[float, ...], ...], lanes: list, states: list, over: tuple[float | None, ...] = ()) -> list:
    """Lanes through sections by their plain recurrence, each from its state (two numbers a section; zero if None).

    A section that has a number in over is one with outer numerators of 1: samples are divided by that number, with one
    rounding, instead of multiplied by b0 and b2, which are rounded themselves.

    Every sample is made by the same operations in the same order as one after the other, so results are equal to the last
    digit. Lanes run side by side, and so do sections: when the first is at a sample, the next is at the one before.
    """
    out, n = list(lanes), len(sections)
    order = sorted((i for i, x in enumerate(lanes) if n and len(x)), key=lambda i: -len(lanes[i]))
    while order:
        longest = len(lanes[order[0]])
        some = [i for i in order[: max(1, SIDE_BY_SIDE // longest)] if 2 * len(lanes[i]) >= longest]
        order = order[len(some) :]
        x = np.zeros((longest + n - 1, len(some)))
        for j, i in enumerate(some):
            x[: len(lanes[i]), j] = lanes[i]
        b0, b1, b2, a1, a2 = (np.array(c)[:, None] for c in zip(*sections))
        divided = [k for k, a0 in enumerate(over) if a0 is not None]
        by = np.ones((n, 1))
        for k in divided:
            b0[k], b2[k], by[k] = 1.0, 1.0, over[k]
        start = np.array([np.zeros(2 * n) if states[i] is None else states[i] for i in some], dtype=np.float64).T
        p, q = start[0::2].copy(), start[1::2].copy()
        v = np.zeros((n + 1, len(some)))  # what goes into each section, and out of the last
        for t in range(longest + n - 1):
            low, high = max(0, t - longest + 1), min(n, t + 1)
            v[0] = x[t]
            at = slice(low, high)
            into = v[at]
            first, last = b0[at] * into, b2[at] * into
            if divided:
                first, last = first / by[at], last / by[at]
            y = first + p[at]
            p[at] = b1[at] * into - a1[at] * y + q[at]
            q[at] = last - a2[at] * y
            v[low + 1 : high + 1] = y
            if high == n:
                x[t - n + 1] = v[n]
        for j, i in enumerate(some):
            out[i] = x[: len(lanes[i]), j].copy()
    return out


def stages(chain: str) -> list[tuple[str, dict[str, str]]]:
    """The filters of a chain, name=key=value:key=value and so on, with commas between them; one without effect is left out."""
    found = []
    for part in filter(None, (p.strip() for p in chain.split(","))):
        name, _, args = part.partition("=")
        if name != "anull":
            found.append((name, dict(a.split("=", 1) for a in args.split(":") if a)))
    return found


LINEAR = (*PASSES, REJECT)


@lru_cache(maxsize=64)
def compiled(chain: str, rate: float) -> StateSpace:
    """The state space of the recurrent filters of a chain; any other filter in it is an error."""
    if chain == WEIGHTING:
        return StateSpace(weighting(rate))
    sections, over = [], []
    for name, args in stages(chain):
        if name not in LINEAR:
            raise ValueError(f"not a recurrent filter: {name}")
        if found := section(name, args, rate):
            sections.append(found)
            over.append(unscaled(name, args, rate)[1] if name == REJECT else None)
    return StateSpace(tuple(sections), tuple(over))


#: A chain of its own: the weighting before loudness is measured.
WEIGHTING = "loudness-weighting"
