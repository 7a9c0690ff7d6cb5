"""Tables written to the folder that driver and executors share: they cut lineage, so lost executors cost nothing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a temporary one, but only if all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: The session's setting with the name of its own folder for scratch tables.
RUN = "spark.lectern.run"


def run_folder(spark: SparkSession) -> str:
    """The session's own folder in the shared one; all scratch tables lie below it."""
    name = spark.conf.get(RUN, None)
    if not name:
        name = f"run-{uuid.uuid4().hex}"
        spark.conf.set(RUN, name)
    return f"{shared_folder(spark)}/{name}"


def drop_run(spark: SparkSession) -> bool:
    """Deletes the session's scratch tables; whether there were any. Results that have not been written elsewhere go with
    them. A new folder is begun when it is needed."""
    if not spark.conf.get(RUN, None):
        return False
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    spark.conf.unset(RUN)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a new table in the shared folder."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
