"""SimHash near-duplicates: fingerprints within 3 bits are linked, linked documents share a component.

Links are found in the embedding of fingerprints by the bit counts of 2-bit segments. The Manhattan distance of two such
vectors never exceeds the Hamming distance of the fingerprints, so vectors of linked fingerprints are within 3 of each
other, and in one half of the segments within 1. The grid has a cell for each vector of a half; a range join within 1 is
made by putting a fingerprint into its own cell and into the next higher one along each segment: of two vectors at
distance 1 the lower one visits the higher one's cell. Members of a cell are compared by Manhattan distance, then exactly.
Segments are narrow since cells are then many: 16 counts of 2 bits tell as much as 24 bits.

A cell gives a spanning forest of its links, never its pairs; a cell of more than CELL fingerprints is cut into chunks
which meet pairwise in tasks of their own. Components come from the forests by alternating large and small stars.

Edge cases: a null or empty text, or one of white space, has no shingle and fingerprint zero, which links like any other.
Equal texts share a fingerprint and are one vertex, however many there are; fingerprints of very many documents are joined
back by broadcast, as there can be only few of them. component_id is the smallest id that is not null; it is null if all
ids of the component are. Repeated rows are kept (one_each keeps one). An empty table gives an empty result. Columns pass
through one_each unchanged, whatever their names.
Ids must be whole numbers, or texts of such: any other ends the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tuned, unused, written

SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Fingerprints that are compared in one task at once.
CELL = 4096
#: A fingerprint with more than this part of all rows is joined by broadcast: at most HOT of them are.
HOT = 1000
SEGMENTS = 32
LOW_BITS = 0x5555555555555555
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SMALL_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_of(text: bytes | None) -> int:
    """The 64-bit SimHash of word shingles, repeats included."""
    import numpy as np
    from xxhash import xxh64_intdigest

    found = (text or b"").translate(SMALL_BYTES).split()
    if not found:
        return 0
    flat = b" ".join(found)
    if len(found) <= SHINGLE:
        return xxh64_intdigest(flat, SEED)  # one shingle: its bits are those of the hash
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    view = memoryview(flat)
    hashes = np.fromiter((xxh64_intdigest(view[s:e], SEED) for s, e in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist())), dtype=np.uint64, count=len(found) - SHINGLE + 1)
    n, total = len(hashes), np.zeros(64, dtype=np.int64)
    for k in range(0, n, 8192):
        total += np.unpackbits(hashes[k : k + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * total > n).tolist()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp): a row for each document; fp is the fingerprint as a signed long."""
    tuned(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.col("text").cast("binary").alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = [fingerprint_of(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array([x - (1 << 64) if x >> 63 else x for x in fps], type=pa.int64())], names=["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def segment_counts(fp: Column) -> Column:
    """The bit counts 0, 1, 2 of all 2-bit segments, written as 00, 01, 11: so the Manhattan distance of two is the number of bits in which they differ."""
    low, high = fp, F.shiftrightunsigned(fp, 1)
    mask = F.lit(LOW_BITS)
    return low.bitwiseOR(high).bitwiseAND(mask).bitwiseOR(F.shiftleft(low.bitwiseAND(high).bitwiseAND(mask), 1))


def cells(counts: Column) -> Column:
    """The cells of a vector: for each half, its own one and, for each segment below 2, the one with a count more there.

    Counts are written as 00, 01, 11, so one more is the lower bit, or else the upper bit, of the segment.
    """
    found = []
    for half in (0, 1):
        first = half * SEGMENTS // 2
        mask = ((1 << SEGMENTS) - 1) << (2 * first)
        own = counts.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        cell = lambda c, home=False, half=half: F.struct(F.lit(half).alias("half"), c.alias("cell"), F.lit(home).alias("home"))
        found.append(cell(own, True))
        for s in range(first, first + SEGMENTS // 2):
            low, high = F.lit(1 << (2 * s)), F.lit((1 << (2 * s + 1)) - (1 << 64) if 2 * s + 1 == 63 else 1 << (2 * s + 1))
            more = F.when(own.bitwiseAND(low) == 0, own.bitwiseOR(low)).when(own.bitwiseAND(high) == 0, own.bitwiseOR(high))
            found.append(F.when(more.isNotNull(), cell(more)))
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def forest(fps, counts):
    """Pairs that connect all fingerprints linked within one cell: a breadth-first search where each is reached once."""
    import numpy as np

    left = np.arange(len(fps))
    edges = []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            near = np.bitwise_count(counts[left] ^ counts[node]) <= DISTANCE
            near &= np.bitwise_count(fps[left] ^ fps[node]) <= DISTANCE
            if near.any():
                reached = left[near].tolist()
                edges += [(node, x) for x in reached]
                frontier += reached
                left = left[~near]
    return edges


def _forests(batches):
    """Over rows sorted by cell: the forest of each cell; at most one cell is held."""
    import numpy as np
    import pyarrow as pa

    names, kept = ["half", "cell", "i", "j"], None

    def solve(rows):
        fps, counts = rows["fp"].to_numpy().view(np.uint64), rows["counts"].to_numpy().view(np.uint64)
        out = [(fps[a], fps[b]) for a, b in forest(fps, counts)]
        return np.array(out, dtype=np.uint64).reshape(-1, 2)

    def flush(tab, last):
        nonlocal kept
        keys = np.stack([tab[n].to_numpy().astype(np.int64) for n in names], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        ends = bounds if last else bounds[:-1]
        found = [solve(tab.slice(a, b - a)) for a, b in zip(ends[:-1], ends[1:])]
        kept = None if last else tab.slice(bounds[-2])
        edges = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(edges[:, 0].view(np.int64) if len(edges) else [], type=pa.int64()), pa.array(edges[:, 1].copy().view(np.int64) if len(edges) else [], type=pa.int64())], names=["a", "b"])

    for batch in batches:
        tab = pa.Table.from_batches([batch])
        tab = pa.concat_tables([kept, tab]).combine_chunks() if kept is not None else tab
        if len(tab):
            yield flush(tab, False)
    if kept is not None and len(kept):
        yield flush(kept, True)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links of distinct fingerprints, enough to connect all that are within DISTANCE bits."""
    vectors = fps.select("fp", segment_counts(F.col("fp")).alias("counts"))
    placed = vectors.select("fp", "counts", F.explode(cells(F.col("counts"))).alias("c")).select("fp", "counts", "c.half", "c.cell", "c.home")
    # Two visitors of a cell that is nobody's own may be 2 apart in this half: they need not meet here.
    shared = placed.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n"), F.bool_or("home").alias("own")).where("n > 1 and own").drop("own")
    chunks = F.ceil(F.col("n") / CELL).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.when(F.col("chunks") > 1, F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: x != F.col("own"))).otherwise(F.array(F.lit(0))))
    members = (
        placed.join(shared, ["half", "cell"])
        .select("half", "cell", "fp", "counts", chunks.alias("chunks"))
        .select("*", own.alias("own"))
        .select("half", "cell", "fp", "counts", "own", other.alias("other"))
        .select("half", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "counts")
    )
    keys = ["half", "cell", "i", "j"]
    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_forests, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the graph with the smallest node that it is connected to."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both if large else both.where("b < a")
        least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        out = near.join(least, "a")
        if large:
            return out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return out.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = mark(e)
    while before[0]:
        e = written(star(written(star(e, True), "large-star"), False), "small-star")
        now = mark(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root): a row for each document."""
    rows = written(fingerprints(docs), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    roots = written(components(links(fps)), "components")
    ids = roots.join(fps, roots["node"] == fps["fp"]).groupBy("root").agg(F.min("first_id").alias("root_id"))
    named = fps.join(roots.join(ids, "root"), F.col("fp") == F.col("node"), "left").select("fp", "n", F.when(F.col("node").isNotNull(), F.col("root_id")).otherwise(F.col("first_id")).alias("component_id"), F.coalesce("root", "fp").alias("root"))
    named = written(named, "named-fingerprints")
    total = fps.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > total // HOT
    # HOT rows at most, by their definition.
    hot = F.broadcast(named.where(often).drop("n"))
    out = rows.join(hot, "fp").unionByName(rows.join(hot.select("fp"), "fp", "left_anti").join(named.where(~often).drop("n"), "fp"))
    return out.select("doc_id", "text_hash", "fp", "component_id", "root")


def one_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component (the first by hash of its text, if all ids are null), with its columns unchanged."""
    best = near_duplicates(docs).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("b"))
    none, some, text = keys = unused(docs, "none", "some", "text_hash")
    chosen = best.select(F.col("b.none").alias(none), F.coalesce("b.id", F.lit(0)).alias(some), F.col("b.hash").alias(text)).distinct()
    names = [f"`{x}`" for x in docs.columns]
    rows = docs.select(*names, F.col("doc_id").isNull().alias(none), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias(some), F.xxhash64(F.coalesce("text", F.lit(""))).alias(text))
    # Repeated rows have the same id and text: one of them stays, and of a task's own only one leaves it, however many there
    # are. Both steps use one shuffle, as their keys are the same.
    return rows.dropDuplicates(keys).join(written(chosen, "chosen"), keys, "left_semi").select(*names)


def report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
