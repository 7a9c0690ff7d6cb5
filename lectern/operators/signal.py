"""Long signals: chunk rows (keys, start, samples) with bounded arrays, or a row for each sample. No signal has to fit in a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lectern.functions.signal import between, clamp, downmix, energy, fade_in, peak, resampled_length, source_position


def exploded(df: DataFrame, keys: list[str], samples: str) -> DataFrame:
    """(keys, pos, v)."""
    return df.select(*keys, F.posexplode(samples).alias("pos", "v"))


def whole(df: DataFrame, keys: list[str], samples: str) -> DataFrame:
    """Signals that are one chunk each, as haloed() gives them, without a shuffle. Empty ones have no row."""
    return df.where(F.size(samples) > 0).select(*keys, F.lit(0).cast("bigint").alias("start"), F.col(samples).alias("samples"), F.size(samples).cast("bigint").alias("n"), F.lit(None).cast("double").alias("after"))


def chunked(df: DataFrame, keys: list[str], samples: str, size: int) -> DataFrame:
    """(keys, start, samples): arrays cut into chunks of so many samples; the last is shorter, an empty one has no row."""
    starts = F.when(F.size(samples) > 0, F.sequence(F.lit(0), F.size(samples) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    rows = df.select(*keys, samples, F.explode(starts).alias("start"))
    return rows.select(*keys, F.col("start").cast("bigint").alias("start"), F.slice(samples, F.col("start") + 1, F.lit(size)).alias("samples"))


def tiled(chunks: DataFrame, keys: list[str], size: int, before: int, after: int) -> DataFrame:
    """(keys, tile, start, samples): each run of size samples with those before and after it, as far as the signal goes.

    Chunks may have any size; each sends to a tile only what the tile needs, in one shuffle. Tile t begins at t * size, start
    is the place of the first sample given.
    """
    stop = F.col("start") + F.size("samples")
    rows = chunks.where(F.size("samples") > 0).select(*keys, F.col("start").cast("bigint").alias("start"), F.col("samples").cast("array<double>").alias("samples"))
    first, last = F.greatest(F.floor((F.col("start") - after) / size), F.lit(0)), F.floor((stop - 1 + before) / size)
    dealt = rows.select("*", F.explode(F.sequence(first, last)).alias("tile"))
    low, high = F.greatest("start", F.col("tile") * size - before), F.least(stop, (F.col("tile") + 1) * size + after)
    part = F.struct(low.alias("start"), F.slice("samples", (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("samples"))
    parts = dealt.where(low < high).groupBy(*keys, "tile").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    whole = parts.select(*keys, "tile", F.get("parts", F.lit(0))["start"].alias("start"), F.flatten(F.transform("parts", lambda p: p["samples"])).alias("samples"))
    return whole.where(F.col("start") + F.size("samples") > F.col("tile") * size)


def mapped(tiles: DataFrame, keys: list[str], size: int, use: Callable) -> DataFrame:
    """(keys, start, samples) by use(samples, tile, at, core): at is where its first core sample lies in samples, core
    how many there are; it gives back where its result begins, and the result."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            starts, made = [], []
            for tile, start, x in zip(batch["tile"], batch["start"], batch["samples"]):
                at = int(tile * size - start)
                first, y = use(np.asarray(x), int(tile), at, min(size, len(x) - at))
                starts.append(first)
                made.append(y)
            yield batch[keys].assign(start=starts, samples=made)

    kind = T.StructType([*(tiles.schema[k] for k in keys), *T.StructType.fromDDL("start bigint, samples array<double>").fields])
    return tiles.mapInPandas(run, kind)


def haloed(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks with n, the samples of their whole signal, and after, the first sample of the next chunk (null for the last).

    Only the first sample and the size of each chunk are sorted; arrays are moved once, by the join.
    """
    by = Window.partitionBy(*keys)
    heads = chunks.where(F.size("samples") > 0).select(*keys, "start", F.size("samples").alias("__size"), F.get("samples", F.lit(0)).alias("__first"))
    heads = heads.select(*keys, "start", F.sum("__size").over(by).cast("bigint").alias("n"), F.lead("__first").over(by.orderBy("start")).alias("after"))
    return chunks.select(*keys, "start", "samples").join(heads, [*keys, "start"])


def resampled(chunks: DataFrame, keys: list[str], old_rate: int, new_rates: list[int]) -> DataFrame:
    """(keys, rate, pos, v): chunks with a halo at other rates, by linear interpolation between sample centres.

    Each chunk makes the points whose left neighbour it holds. Positions are rows before they are computed with, so all
    arithmetic is on plain columns; all rates are made from one scan. Equal rates leave samples as they are.
    """
    n, start, end = F.col("n"), F.col("start"), F.col("start") + F.size("samples")
    rates = chunks.select("*", F.explode(F.array(*map(F.lit, new_rates))).alias("rate"))
    length = F.lit(None).cast("bigint")
    for new in new_rates:
        length = F.when(F.col("rate") == new, resampled_length(n, old_rate, new).cast("bigint")).otherwise(length)
    rates = rates.select("*", length.alias("m"))
    m = F.col("m")
    # One point more than needed at either end; those that belong to a neighbour are filtered by their exact place.
    reach = lambda edge: ((edge.cast("double") + 0.5) * m / n - 0.5).cast("bigint")
    first = F.when(start == 0, F.lit(0).cast("bigint")).otherwise(F.greatest(reach(start) - 1, F.lit(0)))
    last = F.greatest(F.when(end >= n, m - 1).otherwise(F.least(reach(end) + 1, m - 1)), first)
    points = rates.select("*", F.explode(F.sequence(first, last)).alias("pos"))
    placed = points.select("*", source_position(F.col("pos"), n, m).alias("x")).select("*", F.least(F.floor("x"), n - 1).alias("low"))
    here = placed.where((F.col("low") >= start) & (F.col("low") < end)).select("*", F.get("samples", (F.col("low") - start).cast("int")).alias("a"))
    # Beyond the last sample the last one stands.
    right = F.when(F.col("low") + 1 >= n, F.col("a")).otherwise(F.coalesce(F.get("samples", (F.col("low") + 1 - start).cast("int")), F.col("after")))
    return here.select(*keys, "rate", F.col("pos").cast("int").alias("pos"), between(F.col("a"), right, F.col("x") - F.col("low")).alias("v"))


def asr_ready(stereo: DataFrame, keys: list[str], left: str, right: str, old_rate: int = 48000, new_rate: int = 16000) -> DataFrame:
    """(keys, rate, pos, v): what a recogniser takes - the mean of both channels, at its rate - from chunk rows (keys, start,
    left, right) of signals of any length."""
    mono = stereo.select(*keys, F.col("start").cast("bigint").alias("start"), downmix(F.col(left), F.col(right)).alias("samples"))
    return resampled(haloed(mono, keys), keys, old_rate, [new_rate])


def levels(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rms, peak) of signals in chunks; three numbers of each chunk are shuffled."""
    part = chunks.select(*keys, energy(F.col("samples")).alias("e"), F.size("samples").alias("size"), peak(F.col("samples")).alias("p"))
    return part.groupBy(*keys).agg(F.sqrt(F.sum("e") / F.sum("size")).alias("rms"), F.max("p").alias("peak"))


def normalised(chunks: DataFrame, keys: list[str], to_peak: float) -> DataFrame:
    """(keys, start, samples): each signal times one gain, so that its largest sample is to_peak; silence stays silence."""
    gains = levels(chunks, keys).select(*keys, F.when(F.col("peak") > 0, to_peak / F.col("peak")).otherwise(F.lit(1.0)).alias("gain"))
    return chunks.join(gains, keys).select(*keys, "start", F.transform("samples", lambda v: clamp(v * F.col("gain"))).alias("samples"))


def crossfade_plan(chunks: DataFrame, key: str, idx: str, samples: str, overlap: int) -> DataFrame:
    """(key, idx, at, n, until): where chunks of any size begin when each is laid over the end of those before it.

    A chunk fades in over n samples: the overlap, but no more than it has or than there is before it (at least the largest
    chunk so far, and no fade is longer than that). It begins at the sum of size - n over those before it, less its own n.
    Before until no later chunk begins. Only sizes are sorted here, no samples.
    """
    order = Window.partitionBy(key).orderBy(idx)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    heads = chunks.select(key, idx, F.size(samples).cast("bigint").alias("size"))
    faded = heads.select("*", F.least(F.lit(overlap), "size", F.coalesce(F.max("size").over(before), F.lit(0))).cast("bigint").alias("n"))
    placed = faded.select(key, idx, "n", (F.coalesce(F.sum(F.col("size") - F.col("n")).over(before), F.lit(0)) - F.col("n")).cast("bigint").alias("at"))
    later = Window.partitionBy(key).orderBy(F.desc(idx)).rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("*", F.min("at").over(later).alias("until"))


def crossfaded(chunks: DataFrame, key: str, idx: str, samples: str, overlap: int) -> DataFrame:
    """(key, pos, v): chunks of any size, each laid over the end of those before it by overlap samples, fading linearly.

    What only one chunk holds is passed on as it is; only the samples of fades are shuffled, and folded in order of chunks at
    each position, so that fades may follow one another where chunks are shorter than two overlaps. A chunk's number must be
    its own within the signal.
    """
    rows = chunks.join(crossfade_plan(chunks, key, idx, samples, overlap), [key, idx]).select(key, idx, "at", "n", "until", F.posexplode(samples).alias("p", "x"))
    pos = (F.col("at") + F.col("p")).alias("pos")
    alone = (F.col("p") >= F.col("n")) & (F.col("until").isNull() | (F.col("at") + F.col("p") < F.col("until")))
    share = F.when(F.col("p") < F.col("n"), fade_in(F.col("p"), F.col("n"))).alias("share")
    parts = rows.where(~alone).select(key, pos, F.struct(F.col(idx).alias("idx"), "x", share).alias("part")).groupBy(key, "pos").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    folded = F.aggregate("parts", F.lit(0.0), lambda a, c: F.when(c["share"].isNull(), c["x"]).otherwise(a * (1.0 - c["share"]) + c["x"] * c["share"]))
    return rows.where(alone).select(key, pos, F.col("x").alias("v")).unionByName(parts.select(key, "pos", folded.alias("v")))
