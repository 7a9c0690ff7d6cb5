"""Which work is still to be done: skip policies and anti-joins against what exists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def done(size: Column, min_bytes: int | None) -> Column:
    """Whether an output counts as present: any at all (None), or more than min_bytes."""
    return size.isNotNull() if min_bytes is None else F.coalesce(size > min_bytes, F.lit(False))


#: The five meanings of "present" that batch jobs use.
POLICIES = {"exists": None, "non_empty": 0, "over_1000": 1000, "over_10000": 10000, "over_1k_block": 1024}


def policies(size: Column) -> list[Column]:
    return [done(size, least).alias(name) for name, least in POLICIES.items()]


def pending(work: DataFrame, outputs: DataFrame, key: str, size: str | None = None, min_bytes: int | None = None) -> DataFrame:
    """Work without an output that counts as present."""
    have = outputs if size is None else outputs.where(done(F.col(size), min_bytes))
    return work.join(have.select(key), key, "left_anti")


def split_policy(chunks: DataFrame, key: str, present: Column, expected: Column) -> DataFrame:
    """For each talk, whether its chunks count as split: if any is there, as batch jobs decide, or only if all are.

    partial marks the talks on which the two differ: a split that broke off is taken for a whole one.
    """
    out = chunks.groupBy(key).agg(F.count_if(present).alias("n_present"), expected.cast("bigint").alias("n_expected"))
    some, every = F.col("n_present") > 0, F.col("n_present") >= F.col("n_expected")
    return out.select("*", some.alias("skip_split"), every.alias("complete"), (some & ~every).alias("partial"))


def mark_done(outputs: DataFrame, key: str, size: str, folder: str, min_bytes: int = 1000) -> None:
    """Adds the outputs that are large enough to the done table in folder; a key may be marked more than once."""
    outputs.where(done(F.col(size), min_bytes)).select(key).write.mode("append").parquet(folder)


def marked_done(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The keys in the done table, each once."""
    return spark.read.schema(schema).parquet(folder).distinct()


def progress(chunks: DataFrame, by: str, expected: str, is_done: str) -> DataFrame:
    """total, done and remaining chunks, and whether enough are there."""
    return chunks.groupBy(by).agg(
        F.sum(expected).alias("total"),
        F.sum(F.when(F.col(is_done), F.col(expected)).otherwise(0)).alias("done"),
    ).withColumn("remaining", F.col("total") - F.col("done")).withColumn("complete", F.col("done") >= F.col("total"))


def decisions(force_audio: Column, force_asr: Column, force_remux: Column, audio: Column, asr: Column, srt: Column, json: Column, final: Column) -> list[Column]:
    """What a run makes anew. Forcing the ASR audio does not force the transcription, which only looks for its own files."""
    return [
        (force_audio | ~audio).alias("make_audio"),
        (force_audio | force_asr | ~asr).alias("make_asr_audio"),
        (~srt | ~json).alias("transcribe"),
        (force_remux | ~final).alias("remux"),
    ]


def fatal(n_rows: Column, mode: Column, modes: tuple[str, ...]) -> Column:
    """Why an item must not go on: nothing to work on, or a mode that is none; null where it may."""
    return F.when(F.coalesce(n_rows, F.lit(0)) == 0, F.lit("no chunks")).when(~F.coalesce(mode.isin(*modes), F.lit(False)), F.concat(F.lit("invalid mode: "), F.coalesce(mode, F.lit("null"))))
