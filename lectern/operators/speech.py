"""Where there is speech: energies of frames, a threshold with hysteresis, short pauses closed, short sounds left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def energies(chunks: DataFrame, keys: list[str], frame: int) -> DataFrame:
    """(keys, frame, energy, n): the sum of squares of 16-bit samples in each frame, over whatever chunks hold it.

    Whole numbers, so that the sum does not depend on how signals are cut. Partial sums leave each task.
    """
    rows = chunks.select(*keys, "start", F.posexplode("samples").alias("p", "v"))
    level = F.rint(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "v")) * 32767.0).cast("bigint")
    return rows.select(*keys, F.floor((F.col("start") + F.col("p")) / frame).alias("frame"), level.alias("v")).groupBy(*keys, "frame").agg(F.sum(F.col("v") * F.col("v")).alias("energy"), F.count(F.lit(1)).alias("n"))


def speech_segments(chunks: DataFrame, keys: list[str], frame: int, on: int, off: int, pause: int = 0, least: int = 1) -> DataFrame:
    """(keys, first, last, energy): runs of frames in which there is speech, from and to a frame, with the energy in them.

    Speech begins where the mean energy of a frame is at least on, and lasts until it is below off (off <= on). Runs with at
    most pause frames between them are one; of what that gives, runs of fewer than least frames are left out. Only frames are
    sorted by signal, one short row for many samples.
    """
    order = Window.partitionBy(*keys).orderBy("frame")
    mean = lambda level: F.col("energy") - F.lit(level) * F.col("n")
    rows = energies(chunks, keys, frame).withColumn("event", F.when(mean(on) >= 0, 1).when(mean(off) < 0, 0))
    told = rows.withColumn("speech", F.coalesce(F.last("event", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    spoken = told.where("speech = 1").withColumn("gap", F.col("frame") - F.lag("frame").over(order) - 1)
    runs = spoken.withColumn("run", F.sum(F.when(F.col("gap") > pause, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy(*keys, "run").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.sum("energy").alias("energy"))
    return found.where(F.col("last") - F.col("first") + 1 >= least).select(*keys, "first", "last", "energy")
