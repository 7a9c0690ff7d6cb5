"""Putting the tracks of a talk together, and chunks in order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_order(order: str, value: Column) -> Column:
    """An aggregate: the values of a talk's chunks as an array in numeric order."""
    return F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("n"), value.alias("x")))), lambda e: e["x"])


def manifest_of(order: str, name: Column) -> Column:
    """An aggregate: the list of a talk's chunks, one line each."""
    return F.array_join(in_order(order, F.concat(F.lit("file '"), name, F.lit("'"))), "\n")


def manifest(chunks: DataFrame, key: str, order: str, name: Column) -> DataFrame:
    return chunks.groupBy(key).agg(manifest_of(order, name).alias("manifest"), F.count(F.lit(1)).alias("n_chunks"))


def concatenated_of(order: str, text: str) -> Column:
    """An aggregate: chunks joined end to end."""
    return F.array_join(in_order(order, F.col(text)), "")


def first_of(value: Column, order: str, when: Column) -> Column:
    """An aggregate: the value of the first chunk for which a condition holds; null if there is none."""
    return F.min_by(value, F.when(when, F.col(order)))


def muxed(tracks: list[DataFrame], key: str, durations: list[str], shortest: bool = True) -> DataFrame:
    """One row for each key that all tracks have; it lasts as long as the shortest track, or else the longest."""
    joined = reduce(lambda a, b: a.join(b, key), tracks)
    pick = F.least if shortest else F.greatest
    return joined.withColumn("duration_s", pick(*durations))


#: The streams of a final file in order, with the language and title of the subtitle tracks.
STREAMS = ((0, "video", None, None), (1, "audio", None, None), (2, "subtitle", "spa", "Español"), (3, "subtitle", "eng", "English"))


def streams(talks: DataFrame, key: str, durations: list[str]) -> DataFrame:
    """(key, stream, kind, language, title, source_s, duration_s): the four streams of each muxed talk, cut to its duration_s."""
    one = lambda s, d: F.struct(F.lit(s[0]).alias("stream"), F.lit(s[1]).alias("kind"), F.lit(s[2]).cast("string").alias("language"), F.lit(s[3]).cast("string").alias("title"), F.col(d).alias("source_s"))
    rows = talks.select(key, "duration_s", F.explode(F.array(*map(one, STREAMS, durations))).alias("s"))
    return rows.select(key, "s.stream", "s.kind", "s.language", "s.title", "s.source_s", "duration_s")
