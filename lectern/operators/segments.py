"""Cutting timelines: fixed, truncated and overlapping chunks, runs and prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.sources.shared import written

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, `{ts}`)")


def offset_in(ts: str, seconds: Column) -> Column:
    """Microseconds since the start of the tumbling chunk that a timestamp lies in."""
    return F.pmod(micros(ts), seconds.cast("bigint") * 1_000_000)


def floored_count(seconds: Column, chunk: int) -> Column:
    """Chunks by whole seconds, rounded up; a fraction of a second is not counted."""
    return F.floor((F.floor(seconds) + (chunk - 1)) / chunk).cast("bigint")


def truncated(df: DataFrame, duration: str, chunk: int) -> DataFrame:
    """A row for each chunk of [0, duration): idx, start and length; the last is shorter. No row for a duration of 0."""
    n = F.ceil(F.col(duration) / chunk).cast("int")
    rows = df.where(F.col(duration) > 0).withColumn("idx", F.explode(F.sequence(F.lit(0), n - 1)))
    start = (F.col("idx") * chunk).cast("double")
    return rows.withColumn("start", start).withColumn("length", F.least(F.lit(float(chunk)), F.col(duration) - F.col("start")))


def overlapping(df: DataFrame, duration: str, chunk: int, overlap: int) -> DataFrame:
    """As truncated, but each chunk after the first begins overlap seconds early and is longer by as much, up to the end."""
    n = F.ceil(F.col(duration) / chunk).cast("int")
    rows = df.where(F.col(duration) > 0).withColumn("idx", F.explode(F.sequence(F.lit(0), n - 1)))
    early = F.when(F.col("idx") > 0, F.lit(float(overlap))).otherwise(F.lit(0.0))
    start = F.greatest(F.lit(0.0), F.col("idx") * float(chunk) - early)
    rows = rows.withColumn("start", start).withColumn("has_overlap_start", F.col("idx") > 0)
    return rows.withColumn("length", F.least(F.lit(float(chunk)) + early, F.col(duration) - F.col("start")))


def ranked(df: DataFrame, order: str, name: str, rows_a_range: int = 1 << 20) -> DataFrame:
    """df with name: each row's place (from 0) in the order of a column, nulls first, ties by a hash of the whole row; no
    task sees all rows, and however the input is split, places are the same (but among rows that are the same throughout).

    Rows are dealt to sorted ranges - rows of one value too, by the hash, and equal ones by chance - and written once, each with its range
    and its number in it. Counts and places then come from the same table; the counts, one short row for each range of
    rows_a_range rows, give where a range starts.
    """
    parts = max(1, -(-df.count() // rows_a_range))
    hashed = F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])
    dealt = df.withColumn("__hash", hashed).withColumn("__tie", F.rand(7)).repartitionByRange(parts, order, "__hash", "__tie").sortWithinPartitions(order, "__hash").drop("__hash", "__tie")
    ranged = written(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranged")
    part, inside = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    # One row for a million: left to Spark, which broadcasts so short a table and shuffles a long one.
    return ranged.join(before, part == F.col("__part")).withColumn(name, (inside + F.col("__before")).cast("bigint")).drop("__at", "__part", "__before")


def mini_batches(df: DataFrame, order: str, size: int = 200) -> DataFrame:
    """Runs of size rows in order; a size that is not positive means 200."""
    size = size if size > 0 else 200
    return ranked(df, order, "place").withColumn("batch_id", F.floor(F.col("place") / size).cast("bigint"))


def prefix(df: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """Rows less than seconds after the first of their key."""
    first = df.groupBy(key).agg(F.min(ts).alias("first_ts"))
    rows = df.join(first, key)
    return rows.where(micros(ts) - micros("first_ts") < seconds * 1_000_000)


def cut_at_keyframes(wanted: DataFrame, keyframes: DataFrame, key: str, at: str) -> DataFrame:
    """wanted (key, at, ...) with cut: the first keyframe (key, at) of its signal at or after each wanted time, null if none.

    Both are put together and sorted by time, latest first; each wanted time takes the last keyframe passed. One shuffle, and
    no pair of a time and a keyframe is made.
    """
    w = Window.partitionBy(key).orderBy(F.desc(at), F.desc("__keyframe")).rowsBetween(Window.unboundedPreceding, 0)
    both = wanted.withColumn("__keyframe", F.lit(False)).unionByName(keyframes.select(key, at, F.lit(True).alias("__keyframe")), allowMissingColumns=True)
    cut = F.last(F.when(F.col("__keyframe"), F.col(at)), ignorenulls=True).over(w)
    return both.withColumn("cut", cut).where(~F.col("__keyframe")).drop("__keyframe")


def keyframe_chunks(durations: DataFrame, keyframes: DataFrame, key: str, chunk: int) -> DataFrame:
    """(key, idx, start, stop): chunks of wanted length that begin at keyframes, numbered from 0; times in whole units.

    durations (key, duration). Cuts are wanted at multiples of chunk and made at the next keyframe; wanted times that lead to
    the same one, or to none before the end, make no chunk of their own. The first chunk begins at 0.
    """
    last = F.col("duration") - 1
    times = durations.where("duration > 0").select(key, "duration", F.explode(F.sequence(F.lit(0).cast("bigint"), last - F.pmod(last, F.lit(chunk)), F.lit(chunk).cast("bigint"))).alias("at"))
    cuts = cut_at_keyframes(times.where("at > 0"), keyframes, key, "at").where("cut < duration").select(key, "duration", F.col("cut").alias("start")).distinct()
    starts = cuts.unionByName(times.where("at = 0").select(key, "duration", F.col("at").alias("start")))
    w = Window.partitionBy(key).orderBy("start")
    return starts.distinct().select(key, (F.row_number().over(w) - 1).cast("bigint").alias("idx"), "start", F.coalesce(F.lead("start").over(w), F.col("duration")).alias("stop"))
