"""Subtitles: cues from turns, documents from cues and back, languages and translation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.text import blank, collapsed, let, marked, srt_milliseconds, srt_time, unmarked
from lectern.sources.shared import written

CHARS_A_SECOND = 16.0


def timed(turns: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Turns with number (from 1, blank ones included), start_s and end_s: a talk goes on at 16 characters a second."""
    w = Window.partitionBy(key).orderBy(order)
    upto = F.sum(F.length(text)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return turns.withColumn("number", F.row_number().over(w)).withColumn("end_s", upto / CHARS_A_SECOND).withColumn("start_s", (upto - F.length(text)) / CHARS_A_SECOND)


def rendered(segments: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each segment with rendered times and collapsed content, blank ones included."""
    return segments.select(key, F.col("number").cast("bigint").alias("number"), srt_time(F.col("start_s")).alias("start_time"), srt_time(F.col("end_s")).alias("end_time"), collapsed(F.col(text)).alias("content"))


def cues(segments: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each cue that is shown: numbers keep the gaps that blank segments leave."""
    return rendered(segments, key, text).where(F.col("content") != "")


def block(number: Column, start: Column, end: Column, content: Column) -> Column:
    return F.concat(number.cast("string"), F.lit("\n"), start, F.lit(" --> "), end, F.lit("\n"), content, F.lit("\n"))


def documents(cue_rows: DataFrame, key: str) -> DataFrame:
    """One subtitle file for each key: shown blocks in order, a blank line between them, one line end at the close."""
    one = F.when(F.col("content") != "", F.struct("number", block(F.col("number"), F.col("start_time"), F.col("end_time"), F.col("content")).alias("block")))
    ordered = F.transform(F.sort_array(F.collect_list(one)), lambda x: x["block"])
    body = F.regexp_replace(F.array_join(ordered, "\n"), r"\n+\z", "")
    return cue_rows.groupBy(key).agg(F.concat(body, F.lit("\n")).alias("srt"), F.count(one).alias("n_cues"))


def parsed(files: DataFrame, key: str, srt: str) -> DataFrame:
    """The cues of subtitle files: a leading mark of byte order and carriage returns are dropped; blocks start with a number and a time.

    A block is cut at its first two line ends, its second line at the arrow; blocks without a number or two times are not cues.
    """
    clean = F.replace(F.regexp_replace(F.col(srt), "^\ufeff", ""), F.lit("\r\n"), F.lit("\n"))

    def cue(lines: Column) -> Column:
        return let(
            F.split(F.get(lines, F.lit(1)), r"[ \t]*-->[ \t]*", 2),
            lambda times: F.struct(
                F.trim(F.get(lines, F.lit(0))).try_cast("bigint").alias("number"),
                srt_milliseconds(F.get(times, F.lit(0))).alias("start_ms"),
                srt_milliseconds(F.regexp_extract(F.get(times, F.lit(1)), r"^[0-9:.,]+", 0)).alias("end_ms"),
                F.regexp_replace(F.coalesce(F.get(lines, F.lit(2)), F.lit("")), r"\n+\z", "").alias("content"),
            ),
        )

    blocks = F.split(clean, r"\n{2,}(?=\d+[ \t]*\n\d+:)")
    found = F.transform(blocks, lambda b: let(F.split(F.regexp_replace(b, r"^\s+", ""), "\n", 3), cue))
    rows = files.select(key, F.posexplode(found).alias("pos", "cue"))
    return rows.select(key, "pos", "cue.number", "cue.start_ms", "cue.end_ms", "cue.content").where("number is not null and start_ms is not null and end_ms is not null")


def translated(cue_rows: DataFrame, text: str, translate: Callable[[Column], Column] = lambda x: x) -> DataFrame:
    """Content through a translator, with line ends kept; a blank text is left as it is. The default changes nothing."""
    flat = marked(F.col(text))
    return cue_rows.withColumn(text, F.when(blank(F.col(text)), F.col(text)).otherwise(unmarked(translate(flat))))


def translated_once(cue_rows: DataFrame, text: str, load: Callable[[], Callable[[pd.Series], pd.Series]]) -> DataFrame:
    """As translated, by a model on batches of texts: load is called once in each task, and each distinct text is translated
    once, however often it is said. Blank and null texts are left as they are, and no model sees them.

    The distinct texts are a table of their own, shuffled by text; their translations are joined back. Both shuffles deal by
    text, so a text said very often is one row before the model; rows that say it are split by Spark where they pile up.
    """

    @F.pandas_udf("string")
    def model(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        translate = load()
        for batch in batches:
            yield translate(batch)

    flat, new = "__flat", "__translation"
    rows = cue_rows.withColumn(flat, F.when(~blank(F.col(text)), marked(F.col(text))))
    distinct = written(rows.where(F.col(flat).isNotNull()).select(flat).distinct(), "texts")
    dictionary = written(distinct.select(flat, model(flat).alias(new)), "translations")
    done = rows.join(dictionary, flat, "left")
    return done.withColumn(text, F.when(F.col(flat).isNull(), F.col(text)).otherwise(unmarked(F.col(new)))).select(*cue_rows.columns)


def recomposed(cue_rows: DataFrame, key: str) -> DataFrame:
    """Cues with content and a positive length, in order of time, numbered anew without gaps."""
    good = cue_rows.where(~blank(F.col("content")) & (F.col("end_ms") > F.col("start_ms")))
    w = Window.partitionBy(key).orderBy("start_ms", "end_ms", "pos")
    return good.withColumn("number", F.row_number().over(w).cast("bigint")).withColumn("start_time", srt_time(F.col("start_ms") / 1000)).withColumn("end_time", srt_time(F.col("end_ms") / 1000))


def detected_language(result_json: Column) -> Column:
    return F.coalesce(F.nullif(F.get_json_object(result_json, "$.result.language"), F.lit("")), F.lit("unknown"))


def routes(language: Column) -> list[Column]:
    """How each track is made: from the source as it is, by the recogniser's own translation, or by a text translator."""
    return [
        F.when(language == "en", "copy_source").otherwise("asr_translate").alias("en_route"),
        F.when(language == "es", "copy_source").when(language == "en", "translate_source").otherwise("translate_english").alias("es_route"),
    ]


def first_match(rows: DataFrame, table: DataFrame, keys: list[str], order: str) -> DataFrame:
    """rows with the first entry of a small fixed table that has their keys; nulls where there is none."""
    w = Window.partitionBy(*keys).orderBy(order)
    first = table.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return rows.join(first, keys, "left")
