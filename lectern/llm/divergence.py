"""How far sources of a language differ in their words: sums over all terms for pairs of sources, and each one's own terms.

Terms are counted in each task by group (language and source) and term, so one short row for each leaves it; one shuffle by
language and term then gives the counts, the documents that have the term, and the total of the language. What is kept is
written once. Groups are few rows; blocks of terms are priced apart.

A block is a matrix of counts, groups by terms, of which most cells are zero. A quadtree (K = 2) over it knows which
quadrants hold only zeros. All pairs of groups go down the tree together: where the quadrants of both are all zero, the
price of the terms below is that of two unseen terms, times their number; where not, the walk goes on to the leaves, whose
cells are priced one by one. Terms that a block does not hold for either side are priced by their number as well. Groups
beyond TILE are dealt to tiles, and each pair of tiles is a task of its own, so no matrix grows with the number of sources.

All arithmetic is on integers: probabilities by whole division of decimals, prices below 2^63 (all sums are at most
(10^9 + terms)^2 * 4).

Edge cases: null text, lang or source is ''. Groups without terms, and languages without a kept term, have pairs (of value
0 in the latter case) and no terms. Repeated rows are documents of their own. Ties go to the item smaller in UTF-8. One
source alone has no pairs. No rows, no result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Words, tuned, written

LEAST_DOCS, UNIT, TOP = 3, 1_000_000_000, 200
#: Terms of a block, groups of a tile, cells a side of a leaf; counts and bytes of terms that a task holds before it sends them on.
BLOCK, TILE, LEAF = 2048, 256, 8
HELD_COUNTS, HELD_BYTES = 1 << 21, 64 << 20


def counted(docs: DataFrame, most: int = HELD_COUNTS) -> DataFrame:
    """(lang, source, term, c, d): occurrences and documents, once or a few times from each task."""
    tuned(docs.sparkSession)
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    return docs.select(text("text"), text("lang"), text("source")).mapInArrow(lambda batches: _counted(batches, most), "lang string, source string, term string, c bigint, d bigint")


def _counted(batches, most: int):
    import numpy as np
    import pyarrow as pa

    # Bytes that are part of a term stay, A-Z as a-z; all others become spaces.
    kept = np.full(256, 32, dtype=np.uint8)
    kept[128:] = np.arange(128, 256)
    for first in (65, 97):
        kept[first : first + 26] = np.arange(97, 123)
    groups: dict[tuple, int] = {}
    terms: dict[bytes, int] = {}
    parts: list[tuple] = []
    held = size = 0

    def summed(parts):
        keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return keys, *(np.bincount(at, weights=np.concatenate([p[k] for p in parts]), minlength=len(keys)).astype(np.int64) for k in (1, 2))

    def out():
        nonlocal parts, held, size
        keys, c, d = summed(parts)
        names, words = list(groups), list(terms)
        group, term = keys >> 40, keys & ((1 << 40) - 1)
        for a in range(0, len(keys), 1 << 16):
            g, t = group[a : a + (1 << 16)], term[a : a + (1 << 16)]
            lang, source = (pa.array([names[i][k] for i in g.tolist()], pa.string()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([lang, source, pa.array([words[i] for i in t.tolist()], pa.binary()).cast(pa.string()), pa.array(c[a : a + (1 << 16)]), pa.array(d[a : a + (1 << 16)])], names=["lang", "source", "term", "c", "d"])
        groups.clear()
        terms.clear()
        parts, held, size = [], 0, 0

    for batch in batches:
        texts = batch["text"].cast(pa.large_string())
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.zeros(0, dtype=np.uint8)
        plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(kept[data])], offset=texts.offset)
        found = Words(plain, lower=False)
        if not len(found.index):
            continue
        of = np.array([groups.setdefault(x, len(groups)) for x in zip(batch["lang"].to_pylist(), batch["source"].to_pylist())], dtype=np.int64)
        size += sum(len(x) for x in found.distinct if x not in terms)
        ids = np.array([terms.setdefault(x, len(terms)) for x in found.distinct], dtype=np.int64)
        doc = np.repeat(np.arange(len(found.counts), dtype=np.int64), found.counts)
        pairs, times = np.unique(doc << 40 | found.index, return_counts=True)
        parts.append(summed([(of[pairs >> 40] << 40 | ids[pairs & ((1 << 40) - 1)], times, np.ones(len(pairs)))]))
        held += len(parts[-1][0])
        if held > most:
            parts = [summed(parts)]
            held = len(parts[0][0])
        if held > most // 2 and len(parts) == 1 or size > HELD_BYTES:
            yield from out()
    if parts:
        yield from out()


def cells(docs: DataFrame, most: int = HELD_COUNTS) -> DataFrame:
    """(lang, source, term, id, c, total, head): kept terms by group with their counts; id and one head for each term of a language."""
    rows = counted(docs, most).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    rows = rows.withColumn("at", F.monotonically_increasing_id()).select("*", F.sum("d").over(term).alias("docs"), F.sum("c").over(term).alias("total"), F.min("at").over(term).alias("id"))
    return rows.where(F.col("docs") >= LEAST_DOCS).select("lang", "source", "term", "id", "c", "total", (F.col("at") == F.col("id")).alias("head"))


def grouped(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, n, v, lang_n, g, zero): each group with its size, the terms and the size of its language, its number
    there, and the probability of a term that it does not have."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    sizes = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"), F.count_if("head").alias("heads"))
    every = docs.select(text("lang"), text("source")).distinct().join(sizes, ["lang", "source"], "left").fillna(0, ["n", "heads"])
    lang = Window.partitionBy("lang")
    rows = every.select("lang", "source", "n", F.sum("heads").over(lang).cast("bigint").alias("v"), F.sum("n").over(lang).cast("bigint").alias("lang_n"), (F.row_number().over(lang.orderBy("source")) - 1).alias("g"))
    return rows.withColumn("zero", probability(F.lit(0), F.col("n"), F.col("v")))


def probability(count: Column, n: Column, v: Column) -> Column:
    """1 + whole part of UNIT * (count + 1) / (n + v); null where there is nothing to divide by."""
    whole = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), F.nullif((n + v).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")))
    return 1 + whole


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Tree:
    """Which quadrants of a matrix of at least 2 * LEAF cells a side hold anything: levels from the leaves up to one quadrant."""

    def __init__(self, filled):
        levels = [filled.reshape(filled.shape[0] // LEAF, LEAF, filled.shape[1] // LEAF, LEAF).any(axis=(1, 3))]
        while levels[-1].shape != (1, 1):
            x = levels[-1]
            r, c = min(2, x.shape[0]), min(2, x.shape[1])
            levels.append(x.reshape(x.shape[0] // r, r, x.shape[1] // c, c).any(axis=(1, 3)))
        self.levels = levels[::-1]


def together(p, filled):
    """Sums over columns of price(p[i], p[j]) for all pairs of rows, and over how many columns both were unseen, unpriced.

    p: probabilities, rows are groups; filled: where the count is not zero. All pairs of quadrants of the same columns go down
    together; pairs that are empty on both sides stop and only tell their number of columns.
    """
    import numpy as np

    r, c = (1 << max(3, (n - 1).bit_length()) for n in p.shape)
    full = np.zeros((r, c), dtype=bool)
    full[: p.shape[0], : p.shape[1]] = filled
    padded = np.ones((r, c), dtype=np.int64)
    padded[: p.shape[0], : p.shape[1]] = p
    sums, empty = np.zeros((r, r), dtype=np.int64), np.zeros((r, r), dtype=np.int64)
    levels = Tree(full).levels
    a = b = col = np.zeros(1, dtype=np.int64)
    for k, level in enumerate(levels):
        live = level[a, col] | level[b, col]
        rows, wide = r // level.shape[0], c // level.shape[1]
        below = np.zeros((level.shape[0],) * 2, dtype=np.int64)
        # Columns that only fill the matrix up are no terms.
        width = np.clip(p.shape[1] - col * wide, 0, wide)
        np.add.at(below, (a[~live], b[~live]), width[~live])
        empty += np.repeat(np.repeat(below, rows, axis=0), rows, axis=1)
        a, b, col = a[live], b[live], col[live]
        if k + 1 < len(levels):
            fr, fc = levels[k + 1].shape[0] // level.shape[0], levels[k + 1].shape[1] // level.shape[1]
            ia, ib, ic = (x.ravel() for x in np.meshgrid(np.arange(fr), np.arange(fr), np.arange(fc), indexing="ij"))
            a, b, col = ((x[:, None] * f + i).ravel() for x, f, i in ((a, fr, ia), (b, fr, ib), (col, fc, ic)))
    leaf = padded.reshape(r // LEAF, LEAF, c // LEAF, LEAF).transpose(0, 2, 1, 3)
    real = np.arange(c).reshape(-1, LEAF) < p.shape[1]
    for s in range(0, len(a), 1 << 13):
        x, y = leaf[a[s : s + (1 << 13)], col[s : s + (1 << 13)]][:, :, None, :], leaf[b[s : s + (1 << 13)], col[s : s + (1 << 13)]][:, None, :, :]
        d = x - y
        f = np.where(real[col[s : s + (1 << 13)]][:, None, None, :], d * d // y, 0).sum(axis=3)
        at = lambda u: (u[s : s + (1 << 13), None] * LEAF + np.arange(LEAF))
        np.add.at(sums, (at(a)[:, :, None], at(b)[:, None, :]), f)
    return sums[: p.shape[0], : p.shape[0]], empty[: p.shape[0], : p.shape[0]]


def _priced(key, part, tile: int):
    """Sums of one block for the pairs of groups of two tiles: (lang, g, h, value, seen)."""
    import numpy as np
    import pandas as pd

    lang, first, second, _ = key
    named, rows = part[part["id"] < 0].sort_values("g"), part[part["id"] >= 0]
    groups, zero = named["g"].to_numpy(), named["zero"].to_numpy().astype(np.int64)
    terms, at = np.unique(rows["id"].to_numpy().astype(np.int64), return_inverse=True)
    p = np.repeat(zero[:, None], len(terms), axis=1)
    filled = np.zeros(p.shape, dtype=bool)
    row = np.searchsorted(groups, rows["g"].to_numpy())
    p[row, at], filled[row, at] = rows["zero"].to_numpy().astype(np.int64), True
    sums, empty = together(p, filled)
    g, h = np.nonzero((groups[:, None] // tile == first) & (groups[None, :] // tile == second) & (groups[:, None] != groups[None, :]))
    return pd.DataFrame({"lang": lang, "g": groups[g], "h": groups[h], "value": sums[g, h], "seen": len(terms) - empty[g, h]})


def pairs(kept: DataFrame, groups: DataFrame, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(lang, source, item, value): for each group and each other one of its language, the sum of prices over all kept terms."""
    p = probability(F.col("c"), F.col("n"), F.col("v"))
    many = F.greatest(F.lit(1), F.ceil(F.col("v") / block)).cast("bigint")
    tiles = F.floor((F.max("g").over(Window.partitionBy("lang"))) / tile).cast("int")
    placed = groups.withColumn("tiles", tiles)
    mine = F.floor(F.col("g") / tile).cast("int")
    # A group takes part in the pairs of tiles of which one is its own.
    both = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.col("tiles")), lambda t: F.array(F.struct(mine.alias("a"), t.alias("b")), F.struct(t.alias("a"), mine.alias("b"))))))
    rows = kept.select("lang", "source", "id", "c").join(placed, ["lang", "source"])
    numbers = rows.select("lang", "g", F.col("id"), p.alias("zero"), F.pmod(F.xxhash64("id"), many).alias("block"), F.explode(both).alias("t"))
    heads = placed.where("v > 0").select("lang", "g", F.lit(-1).cast("bigint").alias("id"), "zero", F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1)).alias("block"), both.alias("ts"))
    heads = heads.select("lang", "g", "id", "zero", "block", F.explode("ts").alias("t"))
    blocks = numbers.unionByName(heads).select("lang", "t.a", "t.b", "block", "g", "id", "zero")
    sums = blocks.groupBy("lang", "a", "b", "block").applyInPandas(lambda key, part: _priced(key, part, tile), "lang string, g int, h int, value bigint, seen bigint")
    summed = sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    side = lambda g, source, zero: groups.select("lang", F.col("g").alias(g), F.col("source").alias(source), F.col("zero").alias(zero), *(["v"] if g == "g" else []))
    every = side("g", "source", "p0").join(side("h", "item", "q0"), "lang").where(F.col("g") != F.col("h"))
    unseen = (F.col("v") - F.coalesce("seen", F.lit(0))) * price(F.col("p0"), F.col("q0"))
    return every.join(summed, ["lang", "g", "h"], "left").select("lang", "source", "item", F.when(F.col("v") > 0, F.coalesce("value", F.lit(0)) + unseen).otherwise(F.lit(0)).cast("bigint").alias("value"))


def own_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms that a group has more often than its language."""
    rows = kept.join(groups.drop("g", "zero"), ["lang", "source"])
    priced = rows.select("lang", "source", F.col("term").alias("item"), probability(F.col("c"), F.col("n"), F.col("v")).alias("p"), probability(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"))
    return priced.where("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))


def report(docs: DataFrame, top: int = TOP, block: int = BLOCK, tile: int = TILE, most: int = HELD_COUNTS) -> DataFrame:
    kept = written(cells(docs, most), "term-counts")
    groups = written(grouped(docs, kept), "term-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs(kept, groups, block, tile), "pair").unionByName(ranked(own_terms(kept, groups), "term").where(F.col("rank") <= top))
