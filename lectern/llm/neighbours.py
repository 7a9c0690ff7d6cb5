"""Approximate nearest neighbours by cosine: cross-polytope hashing with several probes, then exact scores.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform. A vector's hash is the signed axis nearest
to its rotation; a table's bucket is the axes of two rotations. Each row is in one bucket of each of TABLES tables. A query
looks into the buckets whose two axes its own rotations are nearest to; how many is fitted, not set: the true neighbours of
SAMPLE queries (the smallest by hash of their id, a documented bound) are found among all rows, and the number of buckets is
the least that holds TARGET of them. So recall stays, whatever the data and its size, and only the work changes.

Rows and queries meet by table and first axis. A table's axis with more than SPLIT rows is dealt to several tasks, and the
queries go to each of these; the counts for this are one number for each table and axis. A task cuts its rows by the second
axis and multiplies blocks of rows with the queries that look into them, in double precision. Equal vectors have equal
scores, so of each the smallest few ids are enough, which keeps a group of copies of any size cheap and the result exact.
Of what a task finds, each query's nearest are scored anew, always in the same order of additions, and sent on.

Edge cases: vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id;
shorter vectors are filled up with zeros. Ids that are not numbers end the job. Repeated rows are candidates of their own; a
repeated query has its result as often. Ties go to the smaller id. Fewer candidates than asked for: all. No rows, no result.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import tuned, written

EVERY, NEAREST = 50, 5
TABLES, SAMPLE, TARGET, SEED = 4, 256, 0.98, 20
#: Rows of a table and axis beyond which they go to several tasks; rows and queries that are multiplied at once.
SPLIT, ROWS, QUERIES = 1 << 14, 8192, 1024
#: More than asked for, as products of matrices may differ from the final scores in the last digits.
MORE = 11


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(rid, id, vec): rows that take part, numbered."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), x.alias("vec")).where("id is not null and vec is not null")
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda v: v != 0)).withColumn("rid", F.monotonically_increasing_id()).select("rid", "id", "vec")


class Hashes:
    """Rotations of TABLES tables, two each, for vectors of up to this many components."""

    def __init__(self, components: int, tables: int = TABLES, seed: int = SEED):
        import numpy as np

        self.size = 1 << max(0, (components - 1).bit_length())
        self.tables = tables
        self.signs = np.random.default_rng(seed).integers(0, 2, (tables, 2, 3, self.size)) * 2.0 - 1.0

    def unit(self, vectors):
        """Rows of length 1, filled up with zeros, from an Arrow array of lists."""
        import numpy as np
        import pyarrow.compute as pc

        x = np.zeros((len(vectors), self.size))
        sizes, flat = pc.list_value_length(vectors).to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False)
        x[np.arange(self.size) < sizes[:, None]] = flat
        x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small numbers must not overflow
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    def rotated(self, x, table: int, k: int):
        import numpy as np

        y = x
        for signs in self.signs[table, k]:
            y, h = y * signs, 1
            while h < self.size:
                y = y.reshape(len(x), -1, 2, h)
                y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2)
                h *= 2
            y = y.reshape(len(x), self.size) / np.sqrt(self.size)
        return y

    def nearness(self, x, table: int, k: int):
        """How near each signed axis is: axis i at 2 i, its opposite at 2 i + 1."""
        import numpy as np

        y = self.rotated(x, table, k)
        return np.stack([y, -y], axis=2).reshape(len(x), -1)

    def axes(self, x, table: int):
        """The nearest axes of both rotations."""
        return tuple(self.nearness(x, table, k).argmax(axis=1) for k in (0, 1))

    def order(self, x, table: int):
        """Nearness of each pair of axes, row by row."""
        a, b = (self.nearness(x, table, k) for k in (0, 1))
        return (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)


def cosines(x, y):
    """Row by row, of unit vectors; always added in the same order."""
    return (x * y).sum(axis=1)


def _fitted(rows: DataFrame, hashes: Hashes, queries: list, target: float) -> int:
    """The number of buckets a query has to look into to find target of the neighbours of these (rid, vec) among all rows."""
    import numpy as np
    import pyarrow as pa

    if not queries:
        return 1
    rids, unit = np.array([q[0] for q in queries]), hashes.unit(pa.array([q[1] for q in queries], pa.list_(pa.float64())))

    def nearest(batches):
        best, schema = None, pa.schema([("q", pa.int32()), ("score", pa.float64()), ("axes", pa.list_(pa.int32()))])
        for batch in batches:
            x = hashes.unit(batch["vec"]) if len(batch) else np.zeros((0, hashes.size))
            if not len(x):
                continue
            score = unit @ x.T
            score[rids[:, None] == batch["rid"].to_numpy()[None, :]] = -2
            codes = np.stack([a * 2 * hashes.size + b for a, b in (hashes.axes(x, t) for t in range(hashes.tables))], axis=1)
            k = min(NEAREST, len(x))
            top = np.argpartition(-score, k - 1, axis=1)[:, :k]
            now = np.take_along_axis(score, top, 1), codes[top]
            best = now if best is None else tuple(np.concatenate(z, axis=1) for z in zip(best, now))
            keep = np.argsort(-best[0], axis=1, kind="stable")[:, :NEAREST]
            best = np.take_along_axis(best[0], keep, 1), np.take_along_axis(best[1], keep[:, :, None], 1)
        if best is not None:
            q, j = np.nonzero(best[0] > -2)
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(best[0][q, j]), pa.array(best[1][q, j].astype(np.int32).tolist(), pa.list_(pa.int32()))], schema=schema)

    found = rows.mapInArrow(nearest, "q int, score double, axes array<int>")
    top = Window.partitionBy("q").orderBy(F.desc("score"), "axes")
    true = found.withColumn("k", F.row_number().over(top)).where(F.col("k") <= NEAREST).select("q", "axes").toPandas()  # at most SAMPLE * NEAREST rows
    if not len(true):
        return 1
    q, codes = true["q"].to_numpy(), np.stack(true["axes"].to_numpy())
    rank = np.full(len(q), np.iinfo(np.int64).max)
    for t in range(hashes.tables):
        for k in np.unique(q):
            order = hashes.order(unit[k : k + 1], t)[0]
            mine = q == k
            rank[mine] = np.minimum(rank[mine], (order[None, :] > order[codes[mine, t]][:, None]).sum(axis=1))
    return int(np.sort(rank)[min(len(rank) - 1, int(np.ceil(target * len(rank))) - 1)]) + 1


def _placed(hashes: Hashes, probes: int, every: int):
    """Rows as (table, axis, rid, id, vec, second): each once in a table; queries once for each axis, with a bit for each second axis."""
    axes = 2 * hashes.size

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["table", "axis", "query", "rid", "id", "vec", "second"]

        def rows(t, axis, query, part, at, second):
            vec = part["vec"].take(pa.array(at))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(axis.astype(np.int32)), pa.array(np.full(len(at), query)), part["rid"].take(pa.array(at)), part["id"].take(pa.array(at)), vec, pa.array(second, pa.binary())], names=names)

        for batch in batches:
            if not len(batch):
                continue
            x, asked = hashes.unit(batch["vec"]), np.nonzero(batch["id"].to_numpy() % every == 0)[0]
            for t in range(hashes.tables):
                a, b = hashes.axes(x, t)
                yield rows(t, a, False, batch, np.arange(len(x)), [v.tobytes() for v in b.astype("<i4")])
                step = max(1, (1 << 20) // axes**2)
                for s in range(0, len(asked), step):
                    mine = asked[s : s + step]
                    order = hashes.order(x[mine], t)
                    if probes < order.shape[1]:
                        least = np.partition(order, order.shape[1] - probes, axis=1)[:, order.shape[1] - probes]
                        into = (order >= least[:, None]).reshape(len(mine), axes, axes)
                    else:
                        into = np.ones((len(mine), axes, axes), dtype=bool)
                    q, axis = np.nonzero(into.any(axis=2))
                    bits = np.packbits(into[q, axis], axis=1)
                    for u in range(0, len(q), 2048):
                        yield rows(t, axis[u : u + 2048], True, batch, mine[q[u : u + 2048]], [v.tobytes() for v in bits[u : u + 2048]])

    return run


def _searched(hashes: Hashes, nearest: int):
    """The nearest few of one task's rows for each of its queries: (rid, other, id, score)."""
    axes = 2 * hashes.size

    def run(part):
        import numpy as np
        import pyarrow as pa

        asks = part["query"].to_numpy(zero_copy_only=False)
        rows, queries = part.filter(pa.array(~asks)), part.filter(pa.array(asks))
        out = {"rid": [], "query_id": [], "other": [], "id": [], "score": []}
        if len(rows) and len(queries):
            rid, ids, x = rows["rid"].to_numpy(), rows["id"].to_numpy(), hashes.unit(rows["vec"].combine_chunks())
            second = np.frombuffer(b"".join(rows["second"].to_pylist()), dtype="<i4")
            # Of equal vectors the smallest ids, one more than asked for as a query is not its own neighbour.
            order = np.lexsort((rid, ids))
            _, of = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel(), return_inverse=True)
            order = order[np.argsort(of[order], kind="stable")]
            start = np.r_[0, np.nonzero(np.diff(of[order]))[0] + 1]
            place = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
            keep = order[place <= nearest]
            keep = keep[np.argsort(second[keep], kind="stable")]
            rid, ids, x, second = rid[keep], ids[keep], x[keep], second[keep]
            q_rid, q_id, q_bits = queries["rid"].to_numpy(), queries["id"].to_numpy(), queries["second"].to_pylist()
            for s in range(0, len(q_rid), QUERIES):
                y = hashes.unit(queries["vec"].slice(s, QUERIES).combine_chunks())
                into = np.unpackbits(np.frombuffer(b"".join(q_bits[s : s + QUERIES]), dtype=np.uint8).reshape(len(y), -1), axis=1)[:, :axes].astype(bool)
                held = None
                for r in range(0, len(rid), ROWS):
                    part_second = second[r : r + ROWS]
                    score = np.full((len(y), len(part_second)), -3.0)
                    cuts = np.r_[0, np.nonzero(np.diff(part_second))[0] + 1, len(part_second)]
                    for a, b in zip(cuts, cuts[1:]):
                        who = np.nonzero(into[:, part_second[a]])[0]
                        if len(who):
                            score[who, a:b] = y[who] @ x[r + a : r + b].T
                    score[q_rid[s : s + QUERIES, None] == rid[None, r : r + ROWS]] = -3.0
                    k = min(nearest + MORE, score.shape[1])
                    # Ids break ties among what is cut off here, too.
                    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    now = np.take_along_axis(score, top, 1), top + r
                    held = now if held is None else tuple(np.concatenate(z, axis=1) for z in zip(held, now))
                    keep = np.lexsort((ids[held[1]], -held[0]), axis=1)[:, : nearest + MORE]
                    held = tuple(np.take_along_axis(z, keep, 1) for z in held)
                exact = np.full(held[0].shape, -3.0)
                q, j = np.nonzero(held[0] > -2.5)
                exact[q, j] = cosines(y[q], x[held[1][q, j]])
                keep = np.lexsort((ids[held[1]], -exact), axis=1)[:, :nearest]
                exact, at = np.take_along_axis(exact, keep, 1), np.take_along_axis(held[1], keep, 1)
                q, j = np.nonzero(exact > -2.5)
                for name, value in (("rid", q_rid[s + q]), ("query_id", q_id[s + q]), ("other", rid[at[q, j]]), ("id", ids[at[q, j]]), ("score", exact[q, j])):
                    out[name].append(value)
        kinds = {"rid": pa.int64(), "query_id": pa.int64(), "other": pa.int64(), "id": pa.int64(), "score": pa.float64()}
        return pa.table({n: pa.array(np.concatenate(v) if v else [], kinds[n]) for n, v in out.items()})

    return run


def nearest_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, nearest: int = NEAREST, target: float = TARGET, split: int = SPLIT) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row whose id is divisible by every."""
    spark: SparkSession = tuned(vectors.sparkSession)
    rows = written(usable(vectors, key, vector), "vectors")
    components = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    hashes = Hashes(components)
    sample = rows.where(F.col("id") % every == 0).orderBy(F.xxhash64("id"), "id", "rid").select("rid", "vec").limit(SAMPLE).collect()
    probes = _fitted(rows, hashes, [tuple(r) for r in sample], target)
    placed = rows.mapInArrow(_placed(hashes, probes, every), "table int, axis int, query boolean, rid bigint, id bigint, vec array<double>, second binary")
    # At most TABLES * 2 * size rows: how many tasks the rows of an axis are dealt to.
    counts = rows.mapInArrow(_tallied(hashes), "table int, axis int, n bigint").groupBy("table", "axis").agg(F.ceil(F.sum("n") / split).cast("int").alias("parts"))
    dealt = placed.join(F.broadcast(counts), ["table", "axis"])
    some = F.when(F.col("query"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")))
    tasks = dealt.withColumn("part", F.explode(some)).drop("parts").groupBy("table", "axis", "part")
    found = tasks.applyInArrow(_searched(hashes, nearest), "rid bigint, query_id bigint, other bigint, id bigint, score double")
    # One candidate may come from several tables, with the same score.
    once = found.groupBy("rid", "query_id", "other", "id").agg(F.max("score").alias("score"))
    top = Window.partitionBy("rid").orderBy(F.desc("score"), "id", "other")
    ranked = once.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _tallied(hashes: Hashes):
    """Rows by table and first axis."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        n = np.zeros((hashes.tables, 2 * hashes.size), dtype=np.int64)
        for batch in batches:
            if len(batch):
                x = hashes.unit(batch["vec"])
                for t in range(hashes.tables):
                    n[t] += np.bincount(hashes.nearness(x, t, 0).argmax(axis=1), minlength=n.shape[1])
        t, axis = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(axis.astype(np.int32)), pa.array(n[t, axis])], names=["table", "axis", "n"])

    return run
