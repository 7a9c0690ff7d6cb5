"""Gated loudness, its range and the true peak of signals in chunks, and gains to a target.

Samples are weighted (operators.recurrent), their energy is summed by slots of a tenth of a second, and overlapping blocks are
sums of slots. A slot or block may lie over any number of chunks. Slots are written once; what follows reads only them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.recurrent import WEIGHTING
from lectern.functions.signal import peak
from lectern.sources.shared import written

from .recurrent import filtered
from .resampling import sinc_resampled

#: Fixed values of the measure: offset, absolute gate, gates below the mean for loudness and for its range, its percentiles.
OFFSET, GATE, RELATIVE, RANGE_RELATIVE, PERCENTILES = -0.691, -70.0, -10.0, -20.0, (0.1, 0.95)
#: Slots a second, slots of a block and of a long block; a signal's peak is sought at so many times its rate.
SLOTS, BLOCK, LONG, OVERSAMPLED = 10, 4, 30, 4


def loud(power: Column) -> Column:
    return OFFSET + 10.0 * F.log10(power)


def slots(chunks: DataFrame, keys: list[str], rate: int) -> DataFrame:
    """(keys, slot, energy, n) of weighted samples."""
    kind = T.StructType([*(chunks.schema[k] for k in keys), *T.StructType.fromDDL("slot bigint, energy double, n bigint").fields])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for batch in batches:
            for (_, row), start, x in zip(batch[keys].iterrows(), batch["start"], batch["samples"]):
                slot = (np.arange(start, start + len(x)) * SLOTS) // rate
                found, at, n = np.unique(slot, return_index=True, return_counts=True)
                yield pd.DataFrame({**{k: [row[k]] * len(found) for k in keys}, "slot": found, "energy": np.add.reduceat(np.square(x), at), "n": n})

    parts = filtered(chunks, keys, rate, WEIGHTING).mapInPandas(run, kind)
    return parts.groupBy(*keys, "slot").agg(F.sum("energy").alias("energy"), F.sum("n").alias("n"))


def blocks(by_slot: DataFrame, keys: list[str], rate: int, length: int) -> DataFrame:
    """(keys, block, power): mean energy of each run of so many whole slots, one beginning with each slot."""
    rows = by_slot.select(*keys, F.explode(F.sequence(F.col("slot") - (length - 1), F.col("slot"))).alias("block"), "energy", "n").where("block >= 0")
    sums = rows.groupBy(*keys, "block").agg(F.sum("energy").alias("energy"), F.sum("n").alias("n"))
    # The last slot of a signal may have only a part of its samples.
    whole = F.floor(((F.col("block") + length) * rate + SLOTS - 1) / SLOTS) - F.floor((F.col("block") * rate + SLOTS - 1) / SLOTS)
    return sums.where(F.col("n") == whole).select(*keys, "block", (F.col("energy") / F.col("n")).alias("power"))


def gated(found: DataFrame, keys: list[str], relative: float) -> DataFrame:
    """The blocks above the absolute gate and above the mean of these, less the relative gate."""
    above = found.where((F.col("power") > 0) & (loud(F.col("power")) > GATE))
    gate = above.groupBy(*keys).agg((loud(F.avg("power")) + relative).alias("gate"))
    return above.join(gate, keys).where(loud(F.col("power")) > F.col("gate"))


def loudness(chunks: DataFrame, keys: list[str], rate: int, block: int = BLOCK, long: int = LONG) -> DataFrame:
    """(keys, integrated, range, true_peak): loudness and its range (in LU, by percentiles of hundredths), and decibels of the
    largest sample at four times the rate. Null where no block passes the gates, or for the peak of silence. Signals shorter
    than a long block have no range."""
    by_slot = written(slots(chunks, keys, rate), "slots")
    whole = gated(blocks(by_slot, keys, rate, block), keys, RELATIVE).groupBy(*keys).agg(loud(F.avg("power")).alias("integrated"))
    wide = gated(blocks(by_slot, keys, rate, long), keys, RANGE_RELATIVE).select(*keys, (F.rint(loud(F.col("power")) * 100) / 100).alias("lu"))
    spread = wide.groupBy(*keys).agg((F.percentile("lu", F.lit(PERCENTILES[1])) - F.percentile("lu", F.lit(PERCENTILES[0]))).alias("range"))
    above = sinc_resampled(chunks, keys, rate, OVERSAMPLED * rate).select(*keys, peak(F.col("samples")).alias("p"))
    peaks = above.groupBy(*keys).agg((20.0 * F.log10(F.nullif(F.max("p"), F.lit(0.0)))).alias("true_peak"))
    return peaks.join(whole, keys, "left").join(spread, keys, "left").select(*keys, "integrated", "range", "true_peak")


def gain(integrated: Column, true_peak: Column, to: float, peak_at_most: float) -> Column:
    """The factor to a loudness, less where the true peak would pass its limit; 1 where there is nothing to measure."""
    wanted = F.least(to - integrated, peak_at_most - true_peak)
    return F.when(integrated.isNull() | true_peak.isNull(), F.lit(1.0)).otherwise(F.pow(F.lit(10.0), wanted / 20.0))


def normalised(chunks: DataFrame, keys: list[str], rate: int, to: float = -24.0, peak_at_most: float = -3.0) -> DataFrame:
    """(keys, start, samples): each signal times one gain."""
    gains = loudness(chunks, keys, rate).select(*keys, gain(F.col("integrated"), F.col("true_peak"), to, peak_at_most).alias("gain"))
    return chunks.join(gains, keys).select(*keys, "start", F.transform("samples", lambda v: v * F.col("gain")).alias("samples"))
