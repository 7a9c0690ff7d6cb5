"""Files in and out: media discovery, subtitle and JSON files, WAV samples, summaries."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import file_name, stem

#: Samples that a task holds before it sends them on.
SAMPLES_AT_ONCE = 1 << 20
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discovered(spark: SparkSession, folder: str, pattern: str, min_bytes: int = 0, required: bool = True) -> DataFrame:
    """(path, name, stem, size) of the files of a folder that match and are larger than min_bytes, by path. None is an error.

    Only the listing is read, not the contents.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).where(F.col("length") > min_bytes)
    out = files.select("path", file_name(F.col("path")).alias("name"), stem(F.col("path")).alias("stem"), F.col("length").alias("size")).orderBy("path")
    if required and files.isEmpty():
        raise FileNotFoundError(f"no files match {pattern} in {folder}")
    return out


def subtitle_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, srt): subtitle files as whole texts."""
    return spark.read.option("pathGlobFilter", "*.srt").text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("srt"))


def json_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, json): result files of the recogniser as whole texts."""
    return spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))


def write_documents(documents: DataFrame, key: str, srt: str, folder: str) -> None:
    """One subtitle file below key=… for each row."""
    documents.select(key, F.regexp_replace(srt, r"\n\z", "").alias("value")).write.mode("overwrite").partitionBy(key).text(folder)


def write_summary(results: DataFrame, folder: str) -> None:
    """Result rows as JSON lines, in order of their columns; other alphabets stay readable."""
    results.select(F.to_json(F.struct(*results.columns)).alias("value")).write.mode("overwrite").text(folder)


def write_summary_document(documents: DataFrame, key: str, json: str, folder: str) -> None:
    """One JSON file below key=… for each batch."""
    documents.select(key, F.col(json).alias("value")).write.mode("overwrite").partitionBy(key).text(folder)


def wav_info(data: bytes) -> tuple[int, int, int, bytes]:
    """Rate, channels, bits (32 means floats) and the sample bytes of a RIFF file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate, channels, bits = 12, 0, 0, 0
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        body = data[at + 8 : at + 8 + size]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            kind = struct.unpack("<H", body[24:26])[0] if kind == 0xFFFE and len(body) >= 26 else kind
            if (kind, bits) not in ((1, 16), (3, 32)):
                raise ValueError("only 16-bit PCM and 32-bit float samples are read")
        elif name == b"data":
            return rate, channels, bits, body
        at += 8 + size + size % 2
    raise ValueError("no samples")


def wav_frames(data: bytes, offset: int = 0, frames: int = -1):
    """Rate and a float32 array [channel, frame], always of two dimensions, of at most frames frames from offset (-1: all)."""
    import numpy as np

    rate, channels, bits, body = wav_info(data)
    whole = len(body) // (bits // 8 * channels)
    first = min(max(offset, 0), whole)
    last = whole if frames < 0 else min(first + frames, whole)
    x = np.frombuffer(body, dtype="<i2" if bits == 16 else "<f4", count=(last - first) * channels, offset=first * channels * (bits // 8))
    x = x.reshape(-1, channels).T
    return rate, x.astype(np.float32) / np.float32(32768) if bits == 16 else x.astype(np.float32)


def wav_bytes(rate: int, frames, floats: bool = False) -> bytes:
    """A RIFF file of one signal, or of several channels.

    One dimension is one channel, more than two are an error. Samples are clamped to [-1, 1]; of two dimensions the first is
    the channels if it is at most 16 and not larger than the second. 32-bit floats, or 16-bit numbers with halves to even.
    """
    import numpy as np

    x = np.asarray(frames, dtype=np.float64)
    x = x[None, :] if x.ndim == 1 else x
    if x.ndim != 2:
        raise ValueError(f"expected audio of 1 or 2 dimensions, got {x.ndim}")
    x = np.clip(x, -1.0, 1.0)
    x = x.T if x.shape[0] <= 16 and x.shape[1] >= x.shape[0] else x
    channels, bits = x.shape[1], 32 if floats else 16
    body = x.astype("<f4").tobytes() if floats else np.rint(np.nan_to_num(x) * 32767.0).astype("<i2").tobytes()
    head = struct.pack("<IHHIIHH", 16, 3 if floats else 1, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + head + b"data" + struct.pack("<I", len(body)) + body


def wav_name(path: Column, suffix: str | None = None, folder: str | None = None) -> Column:
    """Where a signal is written: its own path, with _suffix before the extension, and in folder where one is given."""
    name = path if suffix is None else F.regexp_replace(path, r"^(.+?)(\.[^./]*)?$", "$1_" + suffix + "$2")
    return name if folder is None else F.concat(F.lit(folder.rstrip("/") + "/"), file_name(name))


def wav_encoded(signals: DataFrame, keys: list[str], channels: str, rate: int, floats: bool = False) -> DataFrame:
    """(keys, content): each row's array of channels as the bytes of a WAV file."""
    kind = T.StructType([*(signals.schema[k] for k in keys), T.StructField("content", T.BinaryType())])

    def run(batches):
        import numpy as np

        for batch in batches:
            yield batch[keys].assign(content=[wav_bytes(rate, np.stack(x), floats) for x in batch[channels]])

    return signals.select(*keys, channels).mapInPandas(run, kind)


def wav_decoded(contents: DataFrame, keys: list[str], offset: int = 0, frames: int = -1, chunk: int = 1 << 16) -> DataFrame:
    """(keys, sample_rate, channel, start, samples): chunk rows of float samples, from offset and for at most frames frames."""
    kind = T.StructType([*(contents.schema[k] for k in keys), *T.StructType.fromDDL("sample_rate int, channel int, start long, samples array<float>").fields])
    names = [f.name for f in kind.fields]

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows, held = [], 0
            for *key, content in batch[[*keys, "content"]].itertuples(index=False):
                rate, x = wav_frames(bytes(content), offset, frames)
                for c in range(len(x)):
                    for k in range(0, x.shape[1], chunk):
                        rows.append((*key, rate, c, k, x[c, k : k + chunk]))
                        held += len(rows[-1][-1])
                        if held >= SAMPLES_AT_ONCE:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return contents.select(*keys, "content").mapInPandas(run, kind)


def wav_files(spark: SparkSession, folder: str, offset: int = 0, frames: int = -1) -> DataFrame:
    """(path, sample_rate, channel, start, samples) of the WAV files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(folder)
    return wav_decoded(files.select("path", "content"), ["path"], offset, frames)


def write_wav_files(contents: DataFrame, path: str) -> DataFrame:
    """Writes each content to its path, by way of a new name, so that no half file is ever seen; gives (path, size).

    The folder has to be one that all executors reach. A task that is run again writes the same files anew.
    """

    def run(batches):
        import os

        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                store, at = fs.FileSystem.from_uri(name) if "://" in name else (fs.LocalFileSystem(), name.removeprefix("file:"))
                part = f"{at}.{os.getpid()}.part"
                with store.open_output_stream(part) as out:
                    out.write(bytes(content))
                store.move(part, at)
            yield pd.DataFrame({"path": batch["path"], "size": [len(c) for c in batch["content"]]})

    return contents.select(F.col(path).alias("path"), "content").mapInPandas(run, "path string, size long")
