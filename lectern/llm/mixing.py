"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words; a document of it should be taken target / source size times. The whole part
is taken as it is. The fractional parts are paired: words are moved at random from one document of a pair to the other,
so that the expected copies stay as they are and the source's words stay exactly as they are, until one of the two is
settled at 0 or 1; the other meets the next document. Buckets of documents (dealt by a hash of the id) do this in
parallel, each streaming through its rows; what is left, one document for each bucket and source, meets in ever fewer
buckets of a reduction tree, dealt by bucket and source. One document for each source is left at its root and is rounded at
random.

Rows with the same id, text and source are alike: they are counted first and go through the tree as one row, of which
so many as can be are settled at 1 at once; so rows that are repeated very often make no bucket large.

Edge cases: a null text has size 0; documents of size 0 are taken 0 words. A null source is a source of its own, after
all others. Repeated rows and ids are documents of their own. With no words at all every target is 0. An empty table gives
an empty result. Draws come from hashes of ids, texts and sources, so reruns agree; which of several alike rows is taken
is left open. mix() keeps all columns of the documents; where one begins like a new one, underscores are added to the new.
Ids must be whole numbers, or texts of such: any other ends the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, tuned, unused, written

WEIGHTS, MOST, SEED = (5, 2, 1), 3, 20250
KEYS, NEW = ["doc_id", "text_hash", "source"], ["size", "source_size", "target", "copies", "taken"]
#: Documents of a first bucket, on average, and how many buckets of one level meet in one of the next.
BUCKET_ROWS, FAN_IN = 16384, 64
#: So many sorts of repeated rows, some 100 bytes each, are joined by broadcast.
FEW_SORTS = 100_000


def weighed(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight) of all sources: weights repeat over the sources in the order of their code points."""
    totals = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    # Ranks without one task for all: range partitions are counted, and each starts after those before it.
    ranged = written(totals.repartitionByRange(16, F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last()).select("source", "source_size", F.monotonically_increasing_id().alias("at")), "ranged-sources")
    part = F.shiftright("at", 33)
    counts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))  # 16 rows at most
    rank = F.coalesce("before", F.lit(0)) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(offsets), part == F.col("part")).select("source", "source_size", F.get(F.array(*map(F.lit, WEIGHTS)), F.pmod(rank, F.lit(len(WEIGHTS))).cast("int")).alias("weight"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target): targets share all words by weight; none exceeds MOST times its source's size."""
    table = written(weighed(sizes), "weighed-sources")
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (total or 0) / (weight or 1), None
    while total:
        at_most = F.col("source_size") * MOST < F.col("weight") * F.lit(level)
        n, words, rest = table.agg(F.sum(at_most.cast("long")), F.sum(F.when(at_most, F.col("source_size") * MOST).otherwise(0)), F.sum(F.when(at_most, 0).otherwise(F.col("weight")))).first()
        if n == full or not rest:
            break
        level, full = (total - words) / rest, n
    return table.select("source", "source_size", F.least(F.col("source_size") * float(MOST), F.col("weight") * F.lit(float(level))).alias("target"))


def _pair(batches):
    """Rows sorted by bucket and source; gives settled rows and the one left of each bucket and source."""
    import pyarrow as pa

    held = None  # (key, row) of the unsettled document

    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        rows = []

        def put(row, p, settled):
            rows.append({**row, "p": p, "settled": settled})

        for row in (dict(zip(columns, v)) for v in zip(*columns.values())):
            key = (row["bucket"], row["source"])
            p = row["p"]
            if held is not None and held[0] != key:
                put(held[1], held[1]["p"], False)
                held = None
            if p <= 0 or p >= 1 or row["size"] == 0:
                put(row, float(p >= 1), True)
            elif held is None:
                held = (key, row)
            else:
                other = held[1]
                s, q, z = row["size"], other["p"], other["size"]
                gain, loss = min((1 - p) * s, q * z), min(p * s, (1 - q) * z)  # words to this one; words to the other
                if row["u"] * (gain + loss) < loss:
                    row["p"] = 1.0 if gain == (1 - p) * s else p + gain / s
                    other["p"] = 0.0 if gain == q * z else q - gain / z
                else:
                    row["p"] = 0.0 if loss == p * s else p - loss / s
                    other["p"] = 1.0 if loss == (1 - q) * z else q + loss / z
                left = [x for x in (other, row) if 0 < x["p"] < 1]
                for x in (other, row):
                    if not 0 < x["p"] < 1:
                        put(x, x["p"], True)
                for x in left[1:]:  # cannot be but by rounding of floats
                    put(x, float(x["p"] >= 0.5), True)
                held = (key, left[0]) if left else None
        yield _batch(pa, rows, batch.schema)
    if held is not None:
        yield _batch(pa, [{**held[1], "settled": False}], batch.schema)


def _batch(pa, rows, schema):
    fields = [f for f in schema if f.name != "bucket"] + [pa.field("settled", pa.bool_())]
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], type=f.type) for f in fields], names=[f.name for f in fields])


def _sizes(docs: DataFrame, keys: list[str], size: str) -> DataFrame:
    """docs with what tells a row from others that are not alike - id, hash of the text, source - and its size."""
    id_, hash_, source = keys
    return docs.select(
        "*",
        F.col("doc_id").cast("long").alias(id_),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias(hash_),
        F.col("source").cast("string").alias(source),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias(size),
    )


def plan(sizes: DataFrame) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, n, whole, more) of all sorts of rows: of n alike rows each is taken whole times, and more of them once more."""
    goal = written(targets(sizes), "targets")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sorts = written(sizes.groupBy(*KEYS, "size").agg(F.count(F.lit(1)).alias("n")), "sorts")
    # The table of sources was written, so its size is known: Spark broadcasts it below its limit, else it shuffles and splits hot sources.
    each = sorts.join(goal.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    each = each.withColumn("whole", F.floor(wanted)).withColumn("mass", (wanted - F.col("whole")) * F.col("n"))
    each = each.withColumn("sure", F.floor("mass")).withColumn("p", F.col("mass") - F.col("sure")).drop("mass")
    n = max(1, -(-sorts.count() // BUCKET_ROWS))
    draw = lambda level: F.shiftrightunsigned(F.xxhash64(*KEYS, F.lit(SEED + level)), 11) * F.lit(2.0**-53)
    rows = each.withColumn("at", F.pmod(F.xxhash64(*KEYS, F.lit(SEED)), F.lit(n)))
    done, level = [], 1
    while True:
        parts = max(1, -(-rows.count() // BUCKET_ROWS)) if level > 1 else n
        # Large documents first: what is left of a bucket is small.
        ordered = rows.withColumn("u", draw(level)).withColumn("bucket", F.col("at")).repartition(parts, "bucket", "source").sortWithinPartitions("bucket", "source", F.desc("size"), "doc_id", "text_hash")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields if f.name != "bucket") + ", settled boolean"
        out = written(ordered.mapInArrow(_pair, schema), "rounded")
        done.append(out.where("settled"))
        rows = out.where("not settled").drop("settled", "u")
        if n == 1:
            break
        n, level = -(-n // FAN_IN), level + 1
        rows = rows.withColumn("at", F.floor(F.col("at") / FAN_IN))
    every = rows.withColumn("p", (draw(0) < F.col("p")).cast("double"))
    for x in done:
        every = every.unionByName(x.drop("settled", "u"))
    zero = F.lit(0).cast("long")
    more = F.when(F.col("size") > 0, F.col("sure") + F.col("p").cast("long")).otherwise(zero)
    return written(every.select(*KEYS, "size", "source_size", "target", "n", F.when(F.col("size") > 0, F.col("whole")).otherwise(zero).alias("whole"), more.alias("more")), "mixing-plan")


def _with_copies(rows: DataFrame, sorts: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """rows with source_size, target, copies and taken, under these names; more of n alike rows get one copy more."""
    held = sorts.select(*[F.col(c).alias(names[c] if c in names else f"{names['copies']}_{c}") for c in ("source_size", "target", "n", "whole", "more", *KEYS)])
    n, whole, more, *mine = (f"{names['copies']}_{c}" for c in ("n", "whole", "more", *KEYS))
    alike = F.lit(True)
    for a, b in zip(keys, mine):
        alike = alike & F.col(a).eqNullSafe(F.col(b))
    repeated = sorts.where("n > 1").count()
    # The most repeated sorts, whose number is bounded, are told apart before any shuffle; no other has many rows.
    often = held.where(f"`{n}` > 1")
    top = F.broadcast(often.orderBy(F.desc(n), *mine).limit(FEW_SORTS)) if repeated > FEW_SORTS else F.broadcast(often)
    others = rows.join(top, alike, "left_anti") if repeated else rows
    first = others.join(held.where(f"`{n}` = 1") if repeated else held, alike).drop(*mine).withColumn(names["copies"], F.col(whole) + F.col(more))
    if not repeated:
        return first.drop(n, whole, more).withColumn(names["taken"], F.col(names["copies"]) * F.col(names["size"]))
    # Alike rows are numbered in parts, so that no task sees all rows of one sort; they are written, so parts stay as they are.
    part, turn, before = (f"{names['copies']}_{c}" for c in ("part", "turn", "before"))
    many = rows.join(top, alike)
    many = many.unionByName(others.join(often, alike)) if repeated > FEW_SORTS else many
    many = written(many.drop(*mine).withColumn(part, F.pmod(F.monotonically_increasing_id(), F.lit(FAN_IN))), "alike")
    counts = many.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(turn))
    counts = counts.select(*[F.col(k).alias(m) for k, m in zip(keys, mine)], F.col(part).alias(part + "_"), (F.sum(turn).over(Window.partitionBy(*keys).orderBy(part)) - F.col(turn)).alias(before))
    many = many.withColumn(turn, F.row_number().over(Window.partitionBy(*keys, part).orderBy(F.lit(1)))).join(counts, alike & (F.col(part) == F.col(part + "_"))).drop(*mine, part + "_")
    many = many.withColumn(names["copies"], F.col(whole) + (F.col(turn) + F.col(before) <= F.col(more)).cast("long")).drop(part, turn, before)
    out = first.unionByName(many).drop(n, whole, more)
    return out.withColumn(names["taken"], F.col(names["copies"]) * F.col(names["size"]))


def mixed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, copies, taken): a row for each document."""
    tuned(docs.sparkSession)
    keys = ["key_id", "key_hash", "key_source"]
    sizes = written(_sizes(docs.select("doc_id", "text", "source"), keys, "size").select(*[F.col(a).alias(b) for a, b in zip(keys, KEYS)], "size"), "sizes")
    names = {c: c for c in NEW}
    return _with_copies(sizes, plan(sizes), KEYS, names).select(*KEYS, *NEW)


def report(docs: DataFrame) -> DataFrame:
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mix(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, all their columns, and the number of copies and the words of all of them."""
    tuned(docs.sparkSession)
    names, keys = dict(zip(NEW, unused(docs, *NEW))), unused(docs, "key_id", "key_hash", "key_source")
    rows = _sizes(docs, keys, names["size"])
    sizes = written(rows.select(*[F.col(a).alias(b) for a, b in zip(keys, KEYS)], F.col(names["size"]).alias("size")), "sizes")
    taken = plan(sizes).where("whole + more > 0")
    out = _with_copies(rows, taken, keys, names).where(F.col(names["copies"]) > 0)
    return out.select(*[f"`{c}`" for c in docs.columns], *[names[c] for c in NEW])
