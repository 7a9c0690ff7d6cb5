"""The same work on streams: chunk counts by event time, and outputs that are published once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def events(spark: SparkSession, folder: str, files_each: int = 1) -> DataFrame:
    """Event files as they arrive; ts as an instant in UTC."""
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_each).option("pathGlobFilter", "*.parquet").parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def chunk_counts(rows: DataFrame, seconds: int, late: str = "10 minutes") -> DataFrame:
    """Events in each tumbling chunk; chunks are final once the watermark has passed them."""
    return rows.withWatermark("ts", late).groupBy(F.window("ts", f"{seconds} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("chunk_start"), "n")


def pending_once(rows: DataFrame, key: str, late: str = "10 minutes") -> DataFrame:
    """Each key once, however often it is announced: the state is the set of what was taken."""
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])
