"""WARC files with a Merkle fixity audit.

Pages are laid out as WARC records: each task of the input fills files of about FILE_BYTES, so nothing is shuffled for
the layout and no key gathers a third of the records. Records are hashed; 16 neighbours in offset order make a node, 16
nodes the next, up to a root for each file: one task builds the tree of a file, whose size is bounded. Above the files
Spark goes on, over the files of a task and then over tasks, to one root for the replica. All trees of two replicas have
the height of the higher one. They are compared from the root down: only the children of nodes that differ are looked at,
first among files, then, in one task for each file that differs, down to the damaged offset ranges.

Edge cases: null url or html are written as empty; null ids too. Repeated rows are records of their own. A record that
one replica lacks counts as damaged. An empty table has no files and an empty report. Each record is a gzip member that
says which record it is: a member with damage, or a lost one, is one damaged record, and reading goes on at the next.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, tuned, written

FILE_BYTES, FAN_BITS, FILE_BITS = 16 << 20, 4, 20
#: Children of a node; files of one task at most.
FAN_OUT, FILES_A_PART = 1 << FAN_BITS, 1 << FILE_BITS
FILES_A_TASK = 64
END = "\r\n\r\n"
#: Each member has less than 16 MB, so the last byte of its size is 0; larger records have several.
MAGIC, MEMBER_BYTES, READ_BYTES = b"\x1f\x8b\x08\x04", (1 << 24) - 1, 1 << 13


def record(page_id: Column, url: Column, html: Column) -> Column:
    """One response record without its two closing line ends; its date is fixed, so equal pages give equal bytes."""
    body = F.coalesce(html, F.lit(""))
    key = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit(""))).cast("binary"))
    part = lambda a, n: F.substring(key, a, n)
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"),
        F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)),
        F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20]+", "%20"),
        F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Page-ID: "),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(END),
        body,
    )


def laid_out(pages: DataFrame) -> DataFrame:
    """(file, ordinal, offset, length, page_id, url, record): a row for each page, written to the shared folder.

    Each task numbers and measures the records that it reads, and begins a new file when one is full.
    """
    tuned(pages.sparkSession)
    rows = pages.select("page_id", "url", record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        file, ordinal, offset = TaskContext.get().partitionId() * FILES_A_PART, 0, 0
        for batch in batches:
            places = []
            for n in pc.binary_length(batch.column("record")).to_pylist():
                if offset >= FILE_BYTES:
                    file, ordinal, offset = file + 1, 0, 0
                places.append((file, ordinal, offset, n + len(END)))
                ordinal, offset = ordinal + 1, offset + n + len(END)
            numbers = [pa.array([x[i] for x in places], type=pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*numbers, *batch.columns], names=["file", "ordinal", "offset", "length", *batch.schema.names])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    placed = rows.mapInArrow(run, f"file long, ordinal long, offset long, length long, page_id {kind['page_id']}, url {kind['url']}, record string")
    path = new_path(pages.sparkSession, "warc-records")
    placed.write.option("compression", "zstd").parquet(path)  # members of one record each take more room than whole files
    return pages.sparkSession.read.schema(placed.schema).parquet(path)


def member(data: bytes, ordinal: int, part: int) -> bytes:
    """One gzip member; its header says, under a checksum, which record of the file it holds."""
    said = struct.pack("<QI", ordinal, part)
    extra = b"WF" + struct.pack("<H", len(said) + 4) + said + struct.pack("<I", zlib.crc32(said))
    packed = zlib.compressobj(6, zlib.DEFLATED, -15)
    head = MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + packed.compress(data) + packed.flush() + struct.pack("<II", zlib.crc32(data), len(data))


def write_files(records: DataFrame, path: str) -> None:
    """One WARC file for each file number, below file=N, with a gzip member for each record. A file never spans two tasks."""
    # A task for each file, as long as they are few; of many, a task has FILES_A_TASK, of about a gigabyte together. Layout is
    # read from its table, not made again: a second scan may be split otherwise once an executor is lost.
    files = records.select("file").distinct().count()
    n = max(1, min(files, max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), files // FILES_A_TASK)))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for file, ordinal, text in zip(batch.column("file").to_pylist(), batch.column("ordinal").to_pylist(), batch.column("record")):
                data = text.as_buffer().to_pybytes() + END.encode()
                # The last byte of a member's size is 0, and Spark writes it: it is the line separator.
                rows += [(file, ordinal, part, member(data[k : k + MEMBER_BYTES], ordinal, part)[:-1]) for part, k in enumerate(range(0, len(data), MEMBER_BYTES))]
            kinds = {"file": pa.int64(), "ordinal": pa.int64(), "part": pa.int32(), "member": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds.values())], names=list(kinds))

    members = records.select("file", "ordinal", "record").mapInArrow(run, "file long, ordinal long, part int, member binary")
    rows = members.repartition(n, "file").sortWithinPartitions("file", "ordinal", "part")
    rows.select(F.col("member").cast("string").alias("member"), "file").write.partitionBy("file").option("lineSep", "\0").option("compression", "none").text(path)


def split_members(content: bytes):
    """Yields (ordinal, bytes) of each member that is whole; what cannot be read is skipped up to the next member."""
    at = content.find(MAGIC)
    while at >= 0:
        said, check, end = content[at + 16 : at + 28], content[at + 28 : at + 32], 0
        if content[at + 12 : at + 14] == b"WF" and len(check) == 4 and zlib.crc32(said) == struct.unpack("<I", check)[0]:
            unpacked, parts, stop = zlib.decompressobj(31), [], at
            try:
                while not unpacked.eof and stop < len(content):
                    parts.append(unpacked.decompress(content[stop : stop + READ_BYTES]))
                    stop = min(stop + READ_BYTES, len(content))
                end = stop - len(unpacked.unused_data) if unpacked.eof else 0
            except zlib.error:
                pass
            if end:
                yield struct.unpack("<QI", said)[0], b"".join(parts)
        at = content.find(MAGIC, end or at + 1)


def read_leaves(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, digest) of the records in the files that write_files() wrote; records that cannot be read have no row."""
    tuned(spark)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                file, digests = int(re.search(r"/file=(\d+)/", name)[1]), {}
                for ordinal, data in split_members(content.as_py()):
                    digests.setdefault(ordinal, hashlib.sha256()).update(data)
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(digests), type=pa.int64()), pa.array(list(digests), type=pa.int64()), pa.array([d.hexdigest() for d in digests.values()], type=pa.string())], names=["file", "ordinal", "digest"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    return files.mapInArrow(run, "file long, ordinal long, digest string")


def leaves(records: DataFrame, *also: str) -> DataFrame:
    return records.select(*also, "file", "ordinal", "offset", "length", F.sha2(F.concat(F.col("record"), F.lit(END)).cast("binary"), 256).alias("digest"))


def above(nodes: DataFrame, keys: list[str], number: str) -> DataFrame:
    """The next level: each node hashes the digests of up to 16 neighbours in order."""
    up = F.shiftright(number, FAN_BITS)
    joined = F.transform(F.sort_array(F.collect_list(F.struct(F.col(number).alias("n"), F.col("digest").alias("d")))), lambda x: x["d"])
    return nodes.groupBy(*keys, up.alias(number)).agg(F.sha2(F.array_join(joined, "").cast("binary"), 256).alias("digest"))


def height_of(most: int) -> int:
    """Levels above the leaves if the largest number is most; at least one."""
    levels = 1
    while most >> (FAN_BITS * levels):
        levels += 1
    return levels


def file_trees(leaf: DataFrame, height: int) -> DataFrame:
    """(file, level, number, digest): all nodes of each file's tree, leaves at level 0, its root at level height."""

    def run(rows):
        import pyarrow as pa

        level = sorted(zip(rows.column("ordinal").to_pylist(), rows.column("digest").to_pylist()))
        nodes = [(0, *x) for x in level]
        for up in range(1, height + 1):
            parts: dict[int, list[str]] = {}
            for number, digest in level:
                parts.setdefault(number >> FAN_BITS, []).append(digest)
            level = [(number, hashlib.sha256("".join(d).encode()).hexdigest()) for number, d in parts.items()]
            nodes += [(up, *x) for x in level]
        columns = [pa.array([n[i] for n in nodes], type=t) for i, t in enumerate((pa.int32(), pa.int64(), pa.string()))]
        return pa.Table.from_arrays([pa.array([rows.column("file")[0].as_py()] * len(nodes), type=pa.int64()), *columns], names=["file", "level", "number", "digest"])

    return leaf.select("file", "ordinal", "digest").groupBy("file").applyInArrow(run, "file long, level int, number long, digest string")


def upper_levels(roots: DataFrame, heights: tuple[int, int]) -> list[tuple[list[str], DataFrame]]:
    """(keys, nodes) from the files' roots up to the replica's: over the files of a task, then over tasks."""
    nodes = written(roots.select(F.shiftright("file", FILE_BITS).alias("task"), F.col("file").bitwiseAND(F.lit(FILES_A_PART - 1)).alias("file"), "digest"), "merkle")
    levels = [(["task", "file"], nodes)]
    for _ in range(heights[0]):
        nodes = written(above(nodes, ["task"], "file"), "merkle")
        levels.append((["task", "file"], nodes))
    nodes = nodes.select("task", "digest")
    for _ in range(heights[1]):
        nodes = written(above(nodes, [], "task"), "merkle")
        levels.append((["task"], nodes))
    return levels


def differing_files(ours: list[tuple[list[str], DataFrame]], theirs: list[tuple[list[str], DataFrame]]) -> DataFrame:
    """(file) of the files whose roots differ or are missing; children of nodes that agree are not looked at."""
    suspects, of = None, None
    for (keys, a), (_, b) in zip(reversed(ours), reversed(theirs)):
        b = b.withColumnRenamed("digest", "other")
        if suspects is not None:
            # Suspects are nodes one level up; from tasks into files, a task's node is the parent of the task's top node.
            if of == keys:
                named = suspects.select(*[F.col(k).alias(f"s_{k}") for k in of])
                on = lambda x: [x[k] == named[f"s_{k}"] for k in of[:-1]] + [F.shiftright(x[of[-1]], FAN_BITS) == named[f"s_{of[-1]}"]]  # noqa: E731, B023
            else:
                named = suspects.select(F.col("task").alias("s_task"))
                on = lambda x: [x["task"] == named["s_task"]]  # noqa: E731, B023
            a, b = (x.join(named, on(x), "left_semi") for x in (a, b))
        differ = a.join(b, keys, "full").where(~F.col("digest").eqNullSafe(F.col("other"))).select(*keys)
        suspects, of = written(differ, "suspects"), keys
    return suspects.select((F.shiftleft("task", FILE_BITS) + F.col("file")).alias("file"))


def differing_leaves(ours: DataFrame, theirs: DataFrame, files: DataFrame, height: int) -> DataFrame:
    """(file, ordinal) of the leaves that differ, by a descent of both trees of each of these files at once."""

    def run(key, a, b):
        import pyarrow as pa

        trees = [dict(zip(zip(t.column("level").to_pylist(), t.column("number").to_pylist()), t.column("digest").to_pylist())) for t in (a, b)]
        stack, found = [(height, 0)], []
        while stack:
            level, number = node = stack.pop()
            if trees[0].get(node) != trees[1].get(node):
                if level:
                    stack += [(level - 1, (number << FAN_BITS) + k) for k in range(FAN_OUT)]
                else:
                    found.append(number)
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(found), type=pa.int64()), pa.array(found, type=pa.int64())], names=["file", "ordinal"])

    a, b = (x.join(files, "file", "left_semi").groupBy("file") for x in (ours, theirs))
    return a.cogroup(b).applyInArrow(run, "file long, ordinal long")


def compared(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(file, ordinal) of the records in which two replicas' leaves differ."""
    most = ours.select("file", "ordinal").unionByName(theirs.select("file", "ordinal")).agg(F.max("ordinal"), F.max(F.col("file").bitwiseAND(F.lit(FILES_A_PART - 1))), F.max(F.shiftright("file", FILE_BITS))).first()
    height, *upper = (height_of(x or 0) for x in most)
    a, b = (written(file_trees(x, height), "file-trees") for x in (ours, theirs))
    files = differing_files(*(upper_levels(x.where(F.col("level") == height), tuple(upper)) for x in (a, b)))
    return differing_leaves(a, b, files, height)


def damaged(records: DataFrame, every: int = 97) -> DataFrame:
    """A copy for drills: in records whose page id's crc32 is divisible by every, the last character is another one."""
    hit = F.coalesce(F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(every)) == 0, F.lit(False))
    last = F.when(F.right("record", F.lit(1)) == "#", F.lit("%")).otherwise(F.lit("#"))
    cut = F.octet_length(F.right("record", F.lit(1))) == 1  # the length in bytes stays
    return records.withColumn("record", F.when(hit & cut, F.concat(F.left("record", F.length("record") - 1), last)).otherwise(F.col("record")))


def report(pages: DataFrame) -> DataFrame:
    """Every page with its place in the archive and whether the second replica holds it unharmed."""
    spark = pages.sparkSession
    records = laid_out(pages)
    path = new_path(spark, "warc-replica")
    write_files(damaged(records), path)
    ours, theirs = written(leaves(records, "page_id", "url"), "leaves"), written(read_leaves(spark, path), "replica-leaves")
    bad = written(compared(ours, theirs), "damage").withColumn("harmed", F.lit(True))
    return ours.join(bad, ["file", "ordinal"], "left").select("page_id", "url", "file", "ordinal", "offset", "length", F.col("digest").alias("sha256"), F.col("harmed").isNull().alias("intact"))
