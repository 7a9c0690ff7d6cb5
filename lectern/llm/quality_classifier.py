"""A quality classifier: random-indexing word vectors, pooled for each document, and a two-layer network in numpy.

Words are cut into lower-case letters, digits and signs, with marks for capitals and repeats. The vector of a piece is its
own random sparse vector, made from a hash of it, and, for pieces in the table, the sum of such vectors of its neighbours
in the training texts: a piece that training did not see still has a vector of its own. A document is the mean of its
pieces' vectors. The network's probabilities are calibrated by a temperature that is fitted on training rows which the
weights never saw.

Training rows are labelled documents with crc32(doc_id) mod 5 <> 0: SAMPLE of them at most, those with the smallest hash.
VOCABULARY is the size of the table of neighbour sums. Every document is scored over its whole text.

Edge cases: null and empty texts have the zero vector and a score like any other. Null labels and ids are not learned
from. With no training rows all scores are 0.5; with one class only they are near that class. Repeated rows get equal
scores; an empty table gives an empty result.
Ids must be whole numbers, or texts of such: any other ends the job.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, tuned, written

SAMPLE, VOCABULARY, DIMENSIONS, NONZERO, HIDDEN, SEED = 20_000, 20_000, 64, 6, 32, 7
THRESHOLD, FOLDS = 0.3, 5
#: Words that a task pools at once, and words whose vectors it remembers.
AT_ONCE, REMEMBERED = 1 << 16, 1 << 18
PLACE_BITS = (DIMENSIONS - 1).bit_length()
#: Words of more bytes than this count for the marks of repeats.
LONG = 5
PIECE = re.compile(r"[^\W\d_]+|\d+|(?P<sign>[^\w\s]|_)(?P=sign)*")


def pieces_of(word: str) -> list[str]:
    """The pieces of a word; numbers and runs of a sign keep their length by powers of two."""
    if word.isalpha():
        return [word.lower(), "<upper>"] if len(word) > 1 and word.isupper() else [word.lower()]
    out = []
    for m in PIECE.finditer(word):
        p = m.group()
        if p[0].isalpha():
            out.append(p.lower())
            if len(p) > 1 and p.isupper():
                out.append("<upper>")
        elif p[0].isdigit():
            out.append(f"<digits{len(p).bit_length()}>")
        else:
            out.append(f"{p[0]}<{len(p).bit_length()}>")
    return out


def index_vectors(pieces: list[str]) -> np.ndarray:
    """The random sparse vector of each piece: places and signs of NONZERO ones, from the bits of one hash."""
    from xxhash import xxh64_intdigest

    h = np.fromiter((xxh64_intdigest(p, SEED) for p in pieces), dtype=np.uint64, count=len(pieces))
    out, every = np.zeros((len(pieces), DIMENSIONS), dtype=np.float32), np.arange(len(pieces))
    for k in range(NONZERO):
        place = (h >> np.uint64(PLACE_BITS * k)) & np.uint64(DIMENSIONS - 1)
        sign = (h >> np.uint64(PLACE_BITS * NONZERO + k)) & np.uint64(1)
        out[every, place.astype(np.int64)] += 1 - 2 * sign.astype(np.float32)
    return out


def marks(words: Words) -> np.ndarray:
    """For each text, how many long words come again and how many are new: what single words cannot show."""
    n, long = len(words.counts), np.fromiter((len(w) > LONG for w in words.distinct), dtype=bool, count=len(words.distinct))
    where = long[words.index] if len(long) else np.zeros(0, dtype=bool)
    text = np.repeat(np.arange(n), words.counts)[where]
    new = np.bincount(np.unique(text * max(1, len(long)) + words.index[where]) // max(1, len(long)), minlength=n)
    return np.stack([np.bincount(text, minlength=n) - new, new], axis=1)


MARKS = ["<again>", "<new>"]


class Pooling:
    """Mean vectors of texts; the vectors of words met before are remembered."""

    def __init__(self, pieces: list[str], vectors: np.ndarray):
        self.ids, self.vectors = {p: i for i, p in enumerate(pieces)}, vectors
        self.rows: dict[bytes, int] = {}
        self.sums, self.sizes = np.zeros((REMEMBERED + AT_ONCE, DIMENSIONS), dtype=np.float32), np.zeros(REMEMBERED + AT_ONCE, dtype=np.float32)
        self.marks = self.vectors_of(MARKS)

    def vectors_of(self, pieces: list[str]) -> np.ndarray:
        rows = np.fromiter((self.ids.get(p, -1) for p in pieces), dtype=np.int64, count=len(pieces))
        out, new = self.vectors[rows] if len(self.vectors) else np.empty((len(rows), DIMENSIONS), dtype=np.float32), np.flatnonzero(rows < 0)
        out[new] = index_vectors([pieces[i] for i in new.tolist()]) / np.float32(np.sqrt(NONZERO))
        return out

    def rows_of(self, words: list[bytes]) -> np.ndarray:
        """Where the sums of the words' pieces are."""
        if len(self.rows) > REMEMBERED:
            self.rows.clear()
        first = len(self.rows)
        out = np.fromiter((self.rows.setdefault(w, len(self.rows)) for w in words), dtype=np.int64, count=len(words))
        new = [words[k] for k in np.flatnonzero(out >= first).tolist()]
        if new:
            cut = [pieces_of(w.decode(errors="replace")) for w in new]
            sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
            vectors = np.concatenate([self.vectors_of([p for c in cut for p in c]), np.zeros((1, DIMENSIONS), dtype=np.float32)])
            sums = np.add.reduceat(vectors, np.cumsum(sizes) - sizes, axis=0)
            sums[sizes == 0] = 0
            self.sums[first : first + len(new)], self.sizes[first : first + len(new)] = sums, sizes
        return out

    def __call__(self, texts) -> np.ndarray:
        words = Words(texts, lower=False)
        n = len(words.counts)
        total, size = np.zeros((n, DIMENSIONS)), np.zeros(n)
        text = np.repeat(np.arange(n), words.counts)
        for k in range(0, len(text), AT_ONCE):
            used, which = np.unique(words.index[k : k + AT_ONCE], return_inverse=True)
            rows = self.rows_of([words.distinct[i] for i in used])[which]
            of = text[k : k + AT_ONCE]
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            total[of[starts]] += np.add.reduceat(self.sums[rows], starts, axis=0)
            size[of[starts]] += np.add.reduceat(self.sizes[rows], starts)
        found = marks(words)
        total += found @ self.marks
        size += found.sum(axis=1)
        return (total / np.maximum(size, 1)[:, None]).astype(np.float32)


def fold(doc_id: F.Column) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label, part): at most SAMPLE documents; part 1 is for the temperature."""
    known = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("label"))
    some = written(known.orderBy(F.xxhash64("__id", F.lit(SEED)), "__id").limit(SAMPLE), "training-ids")
    # At most SAMPLE short rows: a proven bound. Repeated documents are taken once.
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("__id"))
    part = (F.pmod(F.xxhash64("__id", F.lit(SEED + 1)), F.lit(5)) == 0).cast("int")
    return written(rows.groupBy("__id").agg(F.min("text").alias("text"), F.min("label").alias("label")).select("text", "label", part.alias("part")), "training-rows").repartition(16)


def vocabulary(rows: DataFrame) -> list[str]:
    """The VOCABULARY most frequent pieces of the training texts."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            seen: dict[str, int] = {}
            words = Words(batch.column("text"), lower=False)
            for w, n in zip(words.distinct, words.times().tolist()):
                for p in pieces_of(w.decode(errors="replace")):
                    seen[p] = seen.get(p, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), type=pa.string()), pa.array(list(seen.values()), type=pa.int64())], names=["piece", "n"])

    counts = rows.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r["piece"] for r in counts.orderBy(F.desc("n"), "piece").limit(VOCABULARY).toLocalIterator()]


def context_vectors(rows: DataFrame, pieces: list[str]) -> np.ndarray:
    """Random indexing: each piece's sum of the vectors of its two neighbours on either side, as unit vectors, plus its own."""
    shared = rows.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        import pyarrow as pa

        own = index_vectors(shared.value)
        ids, total = {p: i for i, p in enumerate(shared.value)}, np.zeros_like(own)
        for batch in batches:
            words = Words(batch.column("text"), lower=False)
            cut = [[ids[p] for p in pieces_of(w.decode(errors="replace")) if p in ids] for w in words.distinct]
            flat = np.fromiter((i for c in cut for i in c), dtype=np.int64)
            sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
            starts = np.cumsum(sizes) - sizes
            n = sizes[words.index]
            seq = flat[np.arange(n.sum()) + np.repeat(starts[words.index] - (np.cumsum(n) - n), n)]
            of = np.repeat(np.repeat(np.arange(len(words.counts)), words.counts), n)
            for k in range(0, len(seq), AT_ONCE):
                # A stretch of pieces, with the two before it and behind it as neighbours only.
                low, high = max(0, k - 2), min(len(seq), k + AT_ONCE + 2)
                part, text = seq[low:high], of[low:high]
                near = np.zeros((len(part), DIMENSIONS), dtype=np.float32)
                for d in (1, 2):
                    if len(part) > d:
                        same = (text[d:] == text[:-d])[:, None]
                        near[d:] += own[part[:-d]] * same
                        near[:-d] += own[part[d:]] * same
                part, near = part[k - low : k - low + AT_ONCE], near[k - low : k - low + AT_ONCE]
                order = np.argsort(part, kind="stable")
                first = np.flatnonzero(np.diff(part[order], prepend=-1))
                total[part[order][first]] += np.add.reduceat(near[order], first, axis=0)
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int64()), pa.array(total[used].astype(np.float64).tolist(), type=pa.list_(pa.float64()))], names=["id", "v"])

    parts = rows.select("text").mapInArrow(run, "id long, v array<double>")
    summed = parts.groupBy("id").agg(F.array(*[F.sum(F.get("v", F.lit(k))) for k in range(DIMENSIONS)]).alias("v"))
    own = index_vectors(pieces)
    out = np.zeros_like(own)
    for r in summed.toLocalIterator():
        out[r["id"]] = r["v"]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (0.5 * out / np.maximum(norm, 1e-9) + own / np.sqrt(NONZERO)).astype(np.float32)


class Network:
    """tanh layer, logistic output; Adam with weight decay, fixed seed."""

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60) -> Network:
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.mean) / self.scale
        p = {"w1": rng.normal(0, 1 / np.sqrt(DIMENSIONS), (DIMENSIONS, HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
        m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        for _ in range(epochs):
            for i in np.array_split(rng.permutation(len(z)), max(1, len(z) // 128)):
                h = np.tanh(z[i] @ p["w1"] + p["b1"])
                e = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - y[i]) / len(i)
                back = np.outer(e, p["w2"]) * (1 - h * h)
                grads = {"w1": z[i].T @ back + 1e-3 * p["w1"] / 10, "b1": back.sum(axis=0), "w2": h.T @ e + 1e-3 * p["w2"] / 10, "b2": np.array([e.sum()])}
                t += 1
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - 0.003 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.p, self.temperature = p, 1.0
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.p["w1"] + self.p["b1"]) @ self.p["w2"] + self.p["b2"][0]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Network:
        """The temperature with the least log loss on held-back rows, from a fine geometric grid."""
        s = self.logits(x)
        loss = lambda t: np.mean(np.logaddexp(0, s / t) - y * s / t)
        self.temperature = float(min(np.geomspace(0.25, 8, 200), key=loss))
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray, Network | None]:
    """The pieces, their vectors and the network (none if nothing is labelled)."""
    tuned(docs.sparkSession)
    rows = training_rows(docs, labels)
    pieces = vocabulary(rows)
    vectors = context_vectors(rows, pieces)
    shared = docs.sparkSession.sparkContext.broadcast((pieces, vectors))

    def run(batches):
        import pyarrow as pa

        pool = Pooling(*shared.value)
        for batch in batches:
            x = pool(batch.column("text")).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.list_(pa.float32())), batch.column("label"), batch.column("part")], names=["x", "label", "part"])

    # At most SAMPLE vectors come to the driver.
    got = sorted(rows.mapInArrow(run, "x array<float>, label int, part int").toLocalIterator())
    if not got:
        return pieces, vectors, None
    x, y, part = np.array([r["x"] for r in got]), np.array([float(r["label"] > 0) for r in got]), np.array([r["part"] for r in got])
    held = part == 1
    net = Network().fit(x[~held], y[~held]) if (~held).any() else Network().fit(x, y)
    return pieces, vectors, net.calibrate(x[held], y[held]) if held.any() else net


def scored(docs: DataFrame, model: tuple[list[str], np.ndarray, Network | None]) -> DataFrame:
    """(doc_id, score) of all documents; score: how likely label 1 is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        pieces, vectors, net = shared.value
        pool = Pooling(pieces, vectors)
        for batch in batches:
            scores = net.scores(pool(batch.column("text"))) if net and len(batch) else np.full(len(batch), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, type=pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(docs, train(docs, labels))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
