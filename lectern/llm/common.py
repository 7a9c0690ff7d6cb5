"""What the operators of this subpackage share: written tables, sizes of batches, word classes, free names."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.shared import new_path, shared_folder, written

__all__ = ["BATCH_BYTES", "BATCH_ROWS", "SPACES", "WORD", "Words", "new_path", "shared_folder", "table", "tuned", "unused", "words", "written"]

#: Java and Python patterns of the white space that ends a word, as the contracts state it.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes that a Python worker gets at once: very long texts must not pile up in one batch.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches small enough for whole texts of any length. A smaller setting of the caller's stays."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(f"spark.sql.execution.arrow.{name}", most)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Maximal runs of anything but white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like those given with which no column of df begins, whatever its case; underscores are added to all where one does."""
    have = [c.lower() for c in df.columns]
    tail = ""
    while any(c.startswith((n + tail).lower()) for n in names for c in have):
        tail += "_"
    return [n + tail for n in names]


class Words:
    """The words of a batch of texts: the distinct ones, which of these each word is, and how many words each text has."""

    def __init__(self, texts, lower: bool = True):
        import pyarrow as pa
        import pyarrow.compute as pc

        # A part of an array is copied first: what lies before it in memory must not be read as its text.
        texts = texts.take(pa.array(np.arange(len(texts)))) if texts.offset else texts
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts) if lower else texts)
        # A text without a word would be cut into one empty word.
        some = pc.not_equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
        split = pc.ascii_split_whitespace(trimmed.filter(pa.array(some)))
        self.counts = np.zeros(len(some), dtype=np.int64)
        self.counts[some] = pc.list_value_length(split).to_numpy()
        coded = split.flatten().dictionary_encode()
        self.index, self.dictionary = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary())
        ends = np.frombuffer(self.dictionary.buffers()[1], dtype=np.int64, count=len(self.dictionary) + 1).tolist() if len(self.dictionary) else [0]
        text = self.dictionary.buffers()[2].to_pybytes() if len(self.dictionary) else b""
        self.distinct = [text[x:y] for x, y in zip(ends, ends[1:])]

    def times(self) -> np.ndarray:
        return np.bincount(self.index, minlength=len(self.distinct))
