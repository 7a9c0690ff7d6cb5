"""Media files as Spark data sources: WAV samples by ranges, and files written with a commit.

Reading: files are cut into ranges of bytes, so one file feeds many tasks, and a task reads headers and its own ranges only.
Where there are more than PARTITIONS ranges, those that follow one another share a partition, so that many small files are not
as many tasks. Writing: each attempt of a task writes below a hidden folder of the job; the driver moves what the attempts that
count have written to its place, and drops the rest. A task that dies midway leaves nothing that a reader sees.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Bytes of a range, and frames of a row.
RANGE_BYTES, ROW_FRAMES = 64 << 20, 1 << 16
#: Up to so many ranges are a partition each; beyond, partitions grow with the ranges, but not beyond RANGE_BYTES. A file that
#: is opened counts as so many bytes.
PARTITIONS, OPEN_BYTES = 256, 1 << 16
#: Bytes read at once for the parts of a header, each of which is short.
HEADER = 64


def store_of(path: str):
    """The file system of a path, and the path there. Paths without a scheme are local."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Wave:
    """What a WAV header says: kind of samples, and where they lie."""

    rate: int
    channels: int
    bits: int
    first: int
    frames: int


def header_of(file, size: int) -> Wave:
    """The header of an open file of so many bytes, by its parts; the samples are not read.

    Sizes beyond 4 GB are in a part of their own, or missing, then the samples go on to the end of the file.
    """

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    head = read(0, 12)
    if head[:4] not in (b"RIFF", b"RF64") or head[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, kind, wide = 12, None, None
    while at + 8 <= size:
        part = read(at, HEADER)
        name, n = part[:4], struct.unpack("<I", part[4:8])[0]
        if name == b"ds64":
            wide = struct.unpack("<Q", part[16:24])[0]
        elif name == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack("<HHIIHH", part[8:24])
            code = struct.unpack("<H", part[32:34])[0] if code == 0xFFFE and n >= 26 else code
            if (code, bits) not in ((1, 16), (3, 32)):
                raise ValueError("only 16-bit PCM and 32-bit float samples are read")
            kind = rate, channels, bits
        elif name == b"data":
            if kind is None:
                raise ValueError("samples before their format")
            n = wide if n == 0xFFFFFFFF and wide is not None else n
            n = min(n, size - at - 8) if n != 0xFFFFFFFF else size - at - 8
            return Wave(*kind, at + 8, n // (kind[1] * kind[2] // 8) if kind[1] else 0)
        at += 8 + n + n % 2
    raise ValueError("no samples")


@dataclass
class ByteRange:
    """Bytes from low up to high of a file of so many bytes."""

    path: str
    size: int
    low: int
    high: int


@dataclass
class ByteRanges(InputPartition):
    ranges: list[ByteRange]

    def __init__(self, ranges: list[ByteRange]):
        super().__init__(None)
        self.ranges = ranges


def shared_out(files: list[tuple[str, int]], size: int) -> list[ByteRanges]:
    """Files (path, bytes), in ranges of size, as partitions. Ranges of a partition that are neighbours in a file become one."""
    count = sum(-(-n // size) for _, n in files)
    share = 0 if count <= PARTITIONS else min(max(size, RANGE_BYTES), -(-sum(n + OPEN_BYTES for _, n in files) // PARTITIONS))
    parts, held = [], 0
    for path, n in files:
        for low in range(0, n, size):
            high = min(low + size, n)
            last = parts[-1].ranges[-1] if parts else None
            opened = last is None or last.path != path
            cost = high - low + (OPEN_BYTES if opened else 0)
            if last is None or held + cost > share:
                parts.append(ByteRanges([ByteRange(path, n, low, high)]))
                held = high - low + OPEN_BYTES
                continue
            held += cost
            if opened:
                parts[-1].ranges.append(ByteRange(path, n, low, high))
            else:
                last.high = high
    return parts


class WavReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.offset, self.limit = int(options.get("offset", 0)), int(options.get("frames", -1))
        self.range, self.row = int(options.get("rangebytes", RANGE_BYTES)), int(options.get("rowframes", ROW_FRAMES))
        if self.offset < 0:
            raise ValueError("offset must not be negative")

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = store_of(self.path)
        info = store.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path))
        scheme = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        found = sorted((f.path, f.size) for f in files if f.type == fs.FileType.File and f.base_name.lower().endswith(".wav") and f.base_name[0] not in "._")
        return shared_out([(scheme + p, n) for p, n in found], self.range)

    def read(self, part: ByteRange | ByteRanges) -> Iterator:
        """Batches of the frames that begin within the ranges, a row for each channel and run of frames."""
        import numpy as np
        import pyarrow as pa

        if isinstance(part, ByteRanges):
            for one in part.ranges:
                yield from self.read(one)
            return
        store, path = store_of(part.path)
        with store.open_input_file(path) as file:
            wave = header_of(file, part.size)
            width = max(1, wave.channels * wave.bits // 8)  # a file without channels has no frames
            begin = lambda at: min(wave.frames, max(0, -(-(at - wave.first) // width)))  # noqa: E731  the first frame from a byte on
            low, high = max(begin(part.low), self.offset), begin(part.high)
            if self.limit >= 0:
                high = min(high, self.offset + self.limit)
            for a in range(low, high, self.row):
                n = min(self.row, high - a)
                file.seek(wave.first + a * width)
                x = np.frombuffer(file.read(n * width), dtype="<i2" if wave.bits == 16 else "<f4").reshape(-1, wave.channels)
                x = x.astype(np.float32) / np.float32(32768) if wave.bits == 16 else x.astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.path] * wave.channels),
                        pa.array([wave.rate] * wave.channels, pa.int32()),
                        pa.array(range(wave.channels), pa.int32()),
                        pa.array([a - self.offset] * wave.channels, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(wave.channels + 1, dtype=np.int32) * len(x)), pa.array(np.ascontiguousarray(x.T).ravel())),
                    ],
                    names=["path", "sample_rate", "channel", "start", "samples"],
                )


class WavSource(DataSource):
    """Options: path (a file or folder), offset and frames (of each file), rangeBytes, rowFrames."""

    @classmethod
    def name(cls) -> str:
        return "lectern-wav"

    def schema(self) -> str:
        return "path string, sample_rate int, channel int, start bigint, samples array<float>"

    def reader(self, schema) -> WavReader:
        return WavReader(dict(self.options))


@dataclass
class Files(WriterCommitMessage):
    """What one attempt has written: where, and under which names it is wanted."""

    attempt: str
    names: list[str]


class FilesWriter(DataSourceWriter):
    """Rows (name, part, content) in order of both: a file of each name, of its parts one after the other."""

    def __init__(self, folder: str):
        self.folder, self.job = folder, f"_attempts-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Files:
        store, folder = store_of(self.folder)
        attempt, names, seen, out = f"{self.job}/{uuid.uuid4().hex}", [], set(), None
        try:
            for row in rows:
                if not names or names[-1] != row.name:
                    if out:
                        out.close()
                    if row.name != posixpath.normpath(row.name) or row.name[0] in "/." or row.name in seen:
                        raise ValueError(f"not a name for a file, or not in order: {row.name}")
                    at = f"{folder}/{attempt}/{row.name}"
                    store.create_dir(posixpath.dirname(at), recursive=True)
                    out = store.open_output_stream(at)
                    names.append(row.name)
                    seen.add(row.name)
                out.write(bytes(row.content))
        finally:
            if out:
                out.close()
        return Files(attempt, names)

    def commit(self, messages: list) -> None:
        """Every wanted file to its place, then away with what other attempts have left."""
        store, folder = store_of(self.folder)
        store.create_dir(folder, recursive=True)
        for message in filter(None, messages):
            for name in message.names:
                store.create_dir(posixpath.dirname(f"{folder}/{name}"), recursive=True)
                store.move(f"{folder}/{message.attempt}/{name}", f"{folder}/{name}")
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        store, folder = store_of(self.folder)
        if store.get_file_info(f"{folder}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{folder}/{self.job}")


class FilesSink(DataSource):
    """Option: path, a folder that driver and executors reach."""

    @classmethod
    def name(cls) -> str:
        return "lectern-files"

    def schema(self) -> str:
        return "name string, part bigint, content binary"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options["path"])


def wav_ranges(spark: SparkSession, path: str, offset: int = 0, frames: int = -1, range_bytes: int = RANGE_BYTES, row_frames: int = ROW_FRAMES) -> DataFrame:
    """(path, sample_rate, channel, start, samples) of a WAV file or all those of a folder, from offset and for at most frames
    frames of each (-1: all). start counts from offset."""
    spark.dataSource.register(WavSource)
    options = {"path": path, "offset": offset, "frames": frames, "rangeBytes": range_bytes, "rowFrames": row_frames}
    return spark.read.format(WavSource.name()).options(**options).load()


def write_files(parts: DataFrame, folder: str) -> None:
    """Rows (name, part, content) as files below folder, seen only once all are whole; files of the same name are replaced.

    A file is written by one task from parts in order, none of which has to fit in memory with another.
    """
    spark = parts.sparkSession
    spark.dataSource.register(FilesSink)
    rows = parts.select("name", F.col("part").cast("bigint").alias("part"), F.col("content").cast("binary").alias("content")).where("name is not null and content is not null")
    rows.repartition("name").sortWithinPartitions("name", "part").write.format(FilesSink.name()).option("path", folder).mode("append").save()


def write_subtitle_files(documents: DataFrame, name: str, srt: str, folder: str) -> None:
    """One UTF-8 file for each row, by the name of a column and with .srt behind it."""
    write_files(documents.select(F.concat(F.col(name).cast("string"), F.lit(".srt")).alias("name"), F.lit(0).alias("part"), F.encode(srt, "UTF-8").alias("content")), folder)


def wav_head(rate: int, channels: int, bits: int, frames: int) -> bytes:
    """All that stands before the samples; sizes beyond 4 GB stand in a part of their own."""
    n = frames * channels * bits // 8
    kind = struct.pack("<4sIHHIIHH", b"fmt ", 16, 3 if bits == 32 else 1, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)
    if 36 + n < 1 << 32:
        return struct.pack("<4sI4s", b"RIFF", 36 + n, b"WAVE") + kind + struct.pack("<4sI", b"data", n)
    return struct.pack("<4sI4s4sIQQQI", b"RF64", 0xFFFFFFFF, b"WAVE", b"ds64", 28, 72 + n, n, frames, 0) + kind + struct.pack("<4sI", b"data", 0xFFFFFFFF)


def write_wav_chunks(chunks: DataFrame, name: str, rate: int, folder: str, floats: bool = False) -> None:
    """Chunk rows (name, channel, start, samples) as WAV files: samples clamped to [-1, 1], 16-bit numbers or 32-bit floats.

    Channels of a file are cut alike, at the same starts. Samples are encoded where they are; the header needs only sums.
    """
    bits = 32 if floats else 16

    def encoded(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            content = []
            for x in batch["channels"]:
                x = np.clip(np.stack([np.asarray(c, dtype=np.float64) for c in x], axis=1), -1.0, 1.0)
                content.append(x.astype("<f4").tobytes() if floats else np.rint(np.nan_to_num(x) * 32767.0).astype("<i2").tobytes())
            yield batch[["name", "part"]].assign(content=content)

    def heads(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch[["name"]].assign(part=-1, content=[wav_head(rate, int(c), bits, int(n)) for c, n in zip(batch["channels"], batch["frames"])])

    rows = chunks.select(F.concat(F.col(name).cast("string"), F.lit(".wav")).alias("name"), "channel", F.col("start").cast("bigint").alias("part"), F.col("samples").cast("array<double>").alias("samples"))
    sizes = rows.groupBy("name", "channel").agg(F.sum(F.size("samples")).alias("frames")).groupBy("name").agg(F.count(F.lit(1)).alias("channels"), F.max("frames").alias("frames"))
    whole = rows.groupBy("name", "part").agg(F.transform(F.array_sort(F.collect_list(F.struct("channel", "samples"))), lambda c: c["samples"]).alias("channels"))
    kind = "name string, part bigint, content binary"
    write_files(whole.mapInPandas(encoded, kind).unionByName(sizes.mapInPandas(heads, kind)), folder)
