"""Recurrent filters over chunk rows of signals of any length, by an associative scan of their states.

Chunks are dealt into lanes of LANE samples. What a lane does to the state of a filter is affine: it multiplies it by a matrix
that depends on the lane's length only, and adds what the lane alone would leave. Each task works that out for its lanes from a
state of zero. These short rows are composed by spans of SPAN samples, then over the spans of a signal, and give the state at
the start of each lane. From there a second pass makes the samples by the plain recurrence, all lanes of a task side by side.
So a signal of one lane is, to the last digit, what one sample after the other gives; the first sample of another lane begins
from a state that is summed up in another order. No task holds more of a signal than its lanes of a batch, or more than
SPAN / LANE short rows of it and one row for each of its spans.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.recurrent import compiled, plain

from .signal import tiled

#: Samples of a lane, and samples whose lanes are composed to one row.
LANE, SPAN = 1 << 16, 1 << 26


def _kind(df: DataFrame, keys: list[str], rest: str) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL(rest).fields])


def _composed(rows, rate: float, start=None):
    """Lanes in order: the states at their starts, and behind the last one, from start (zero if None)."""
    import numpy as np

    space = compiled(rows["__chain"].iloc[0], rate)
    state, states = np.zeros(space.size) if start is None else np.asarray(start), []
    for n, left in zip(rows["n"], rows["left"]):
        states.append(state)
        state = space.power(int(n)) @ state + np.asarray(left)
    return states, state


def filtered(chunks: DataFrame, keys: list[str], rate: float, chain: str | Column, span: int = SPAN, lane: int = LANE, divided: bool = False) -> DataFrame:
    """(keys, start, samples): chunk rows through the filters of a chain, a text or a column that is the same in all chunks of
    a signal. Chunks must follow one another without gaps; empty ones are left out. A null chain changes nothing. Rows that
    come back begin at multiples of lane, or where the signal begins. If divided, samples are divided by a0 where a notch has
    numerators of 1, else they are multiplied by 1 / a0: the same but for the last digits."""
    import pandas as pd

    chain = F.lit(chain) if isinstance(chain, str) else chain
    lanes = tiled(chunks.withColumn("__chain", F.coalesce(chain, F.lit(""))), [*keys, "__chain"], lane, 0, 0)

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            left = [(space := compiled(c, rate)).run(np.asarray(x), np.zeros(space.size))[1].tolist() for c, x in zip(batch["__chain"], batch["samples"])]
            yield batch[[*keys, "__chain", "tile"]].assign(n=[len(x) for x in batch["samples"]], left=left)

    def spans(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("tile")
        return group.iloc[:1][[*keys, "__span", "__chain"]].assign(n=group["n"].sum(), left=[_composed(group, rate)[1].tolist()])

    def over_spans(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("__span")
        return group[[*keys, "__span"]].assign(state=[s.tolist() for s in _composed(group, rate)[0]])

    def within(key: tuple, group: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("tile")
        states, last = _composed(group, rate, starts["state"].iloc[0])
        # The state behind a lane is that at the start of the next.
        return group[[*keys]].assign(__next=group["tile"] + 1, state=[s.tolist() for s in [*states[1:], last]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            made = np.empty(len(batch), dtype=object)
            for c, at in batch.reset_index(drop=True).groupby("__chain").indices.items():
                space = compiled(c, rate)
                done = plain(space.sections, [np.asarray(batch["samples"].iloc[i]) for i in at], [batch["state"].iloc[i] for i in at], space.over if divided else ())
                for i, y in zip(at, done):
                    made[i] = y
            yield batch[[*keys, "start"]].assign(samples=made)

    # A lane that is not full is the last of its signal: nothing comes after it.
    full = lanes.where(F.col("start") + F.size("samples") == (F.col("tile") + 1) * lane)
    short = full.mapInPandas(leave, _kind(lanes, keys, "__chain string, tile bigint, n bigint, left array<double>")).withColumn("__span", F.floor(F.col("tile") * lane / span))
    by_span = short.groupBy(*keys, "__span").applyInPandas(spans, _kind(lanes, keys, "__span bigint, __chain string, n bigint, left array<double>"))
    starts = by_span.groupBy(*keys).applyInPandas(over_spans, _kind(lanes, keys, "__span bigint, state array<double>"))
    states = short.groupBy(*keys, "__span").cogroup(starts.groupBy(*keys, "__span")).applyInPandas(within, _kind(lanes, keys, "__next bigint, state array<double>"))
    states = states.select(*(F.col(k).alias(f"__of_{k}") for k in keys), "__next", "state")
    same = F.col("tile") == F.col("__next")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return lanes.join(states, same, "left").select(*keys, "__chain", "start", "samples", "state").mapInPandas(run, _kind(lanes, keys, "start bigint, samples array<double>"))
