"""Batch summaries and running estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def batch_summary(results: DataFrame, key: str, failed: Column) -> DataFrame:
    """Items, failures and the exit status of each batch."""
    out = results.groupBy(key).agg(F.count(F.lit(1)).alias("n_items"), F.count_if(failed).alias("n_failed"))
    return out.withColumn("n_ok", F.col("n_items") - F.col("n_failed")).withColumn("exit_status", (F.col("n_failed") > 0).cast("int"))


def result_json(columns: list[str]) -> Column:
    """A result row as JSON text with its columns in order."""
    return F.to_json(F.struct(*columns))


def summary_document(results: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """(key, json, n_items): the results of each batch, in order, as one JSON array with an indent of 2; other alphabets stay readable.

    A batch's document is one row, as it is one file.
    """
    field = lambda c: F.concat(F.lit(f'    "{c}": '), F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", ""))
    item = F.concat(F.lit("  {\n"), F.concat_ws(",\n", *map(field, columns)), F.lit("\n  }"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("x")))), lambda e: e["x"])
    out = results.groupBy(key).agg(ordered.alias("items"))
    return out.select(key, F.concat(F.lit("[\n"), F.array_join("items", ",\n"), F.lit("\n]")).alias("json"), F.size("items").cast("bigint").alias("n_items"))


def eta(results: DataFrame, key: str, order: list[str], elapsed: str) -> DataFrame:
    """After each item: items done, seconds elapsed (summed as decimals, so order of addition does not show), mean and time left.

    Items that were skipped count as done, so a resumed batch looks faster than it is.
    """
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(key)
    out = results.withColumn("done", F.count(F.lit(1)).over(w)).withColumn("total", F.count(F.lit(1)).over(every))
    out = out.withColumn("elapsed_s", F.sum(F.col(elapsed).cast("decimal(18,2)")).over(w).cast("double"))
    return out.withColumn("mean_s", F.col("elapsed_s") / F.col("done")).withColumn("eta_s", F.col("mean_s") * (F.col("total") - F.col("done")))


def dispatched(jobs: DataFrame, key: str, order: str, capacities: list[int]) -> DataFrame:
    """Which device takes each job of a batch while none has ended: devices fill in turn, the rest wait."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    device, below = F.lit(None).cast("int"), sum(capacities)
    for k in range(len(capacities) - 1, -1, -1):
        device = F.when(F.col("place") <= below, F.lit(k)).otherwise(device)
        below -= capacities[k]
    return jobs.withColumn("place", place.cast("bigint")).withColumn("device", device).withColumn("state", F.when(F.col("device").isNull(), "waiting").otherwise("running"))
