"""Document scores by masked pseudo-likelihood under a bidirectional window network trained in numpy.

Every word is predicted from the two words on either side of it, itself masked. All words of the corpus are counted by
Spark, as themselves. The HEAD most frequent have a place of their own: classes of MEMBERS neighbours in frequency, and
the network gives log p(class | both sides) and log p(member | class, both sides). All rarer words share one more class,
whose members are groups of words by how they end; log p(word | group) is the word's share of the group's count. The sum
over all words is the log pseudo-likelihood of a document, and the probabilities of all words of the corpus, given any
two sides, add up to 1 less a count kept in each group for words not met.

Training is data-parallel: the texts are dealt by hash to shards of about SHARD_WORDS words, in order of hash; each shard
takes one pass of gradient steps over all positions of all of its documents from a common start, the shares of the counts;
Spark averages the rows of the weight tables, weighted by how often each shard has met them. The counts grow with the corpus; the network has a fixed size: rare neighbours share rows by hash.

The LEXICON most frequent words are broadcast; the counts of the others are joined to the words of the documents, and
as all words that are in many places are in the broadcast, no key of that join is large.

Edge cases: null and empty texts have 0 words and a log probability of 0; their mean is null. Words beyond either end of a
text are a padding word. Repeated rows are scored each, and count each time. Extra columns are not read. An empty table
gives an empty result. Neither counts nor weights depend on how the input is split into tasks.
Ids must be whole numbers, or texts of such: any other ends the job.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, tuned, written

LEXICON, HEAD, MEMBERS, RARE_ROWS, WIDTH, SIDE, SEED = 1 << 18, 4096, 64, 12288, 16, 2, 11
#: Words that are trained on one after the other; the number of shards follows from the words of the corpus.
SHARD_WORDS = 1 << 21
RATE, START, STEP, CHUNK, COUNTED_AT_ONCE = 0.3, 0.1, 8192, 16384, 1 << 17


def counted(docs: DataFrame) -> DataFrame:
    """(word, n): every word of the corpus and how often it occurs."""

    def run(batches):
        import pyarrow as pa

        def sent(counts):
            return pa.RecordBatch.from_arrays([pa.array(list(counts), type=pa.binary()), pa.array(list(counts.values()), type=pa.int64())], names=["word", "n"])

        counts: dict[bytes, int] = {}
        for batch in batches:
            words = Words(batch.column("text"))
            for word, n in zip(words.distinct, words.times().tolist()):
                counts[word] = counts.get(word, 0) + n
            if len(counts) >= COUNTED_AT_ONCE:
                yield sent(counts)
                counts = {}
        if counts:
            yield sent(counts)

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def group(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % MEMBERS


def group_column(word: Column) -> Column:
    return F.pmod(F.crc32(F.substring(word, -2, 2)), F.lit(MEMBERS)).cast("int")


class Lexicon(dict):
    """The code of each word: its rank if it is broadcast, or one that tells its group and its row of the network."""

    def __init__(self, words: list[bytes], counts: np.ndarray, totals: np.ndarray, head: int = HEAD, members: int = MEMBERS, rare_rows: int = RARE_ROWS):
        super().__init__(zip(words, range(len(words))))
        self.size, self.head, self.members, self.rare_rows = len(words), min(head, len(words)), members, rare_rows
        self.rare_class, self.rows = -(-head // members), head + rare_rows  # one more row is the padding
        rare = words[self.head :]
        hashed = np.concatenate([np.fromiter((self.place(w) for w in rare), dtype=np.int64, count=len(rare)), np.arange(rare_rows * members), [rare_rows * members]])
        rank = np.arange(self.head)
        self.row = np.concatenate([rank, head + hashed // members]).astype(np.uint16)
        self.of = np.concatenate([rank // members, np.full(len(hashed), self.rare_class)]).astype(np.uint8)
        self.member = np.concatenate([rank % members, hashed % members]).astype(np.uint8)
        self.padding = len(self.row) - 1
        #: log p(word | member); what is not broadcast is added by a join
        self.within = np.zeros(len(self.row))
        self.within[self.head : self.size] = np.log(counts[self.head :]) - np.log(totals + 1)[self.member[self.head : self.size]]
        self.prior = np.full((self.rare_class + 1, members), 1e-6)
        np.add.at(self.prior, (self.of[: self.head], self.member[: self.head]), counts[: self.head])
        self.prior[-1] += totals + 1

    def place(self, word: bytes) -> int:
        return zlib.crc32(word) % self.rare_rows * self.members + zlib.crc32(word[-2:]) % self.members

    def __missing__(self, word: bytes) -> int:
        return self.size + self.place(word)

    def codes(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all words with SIDE paddings around each text; where words stand."""
        counts, n = words.counts, len(words.index)
        at = np.arange(n) + SIDE * (np.repeat(np.arange(len(counts)), counts) + 1)
        padded = np.full(n + SIDE * (len(counts) + 1), self.padding, dtype=np.int32)
        padded[at] = np.fromiter(map(self.__getitem__, words.distinct), dtype=np.int32, count=len(words.distinct))[words.index]
        return padded, at


_LATEST: list = [None, None]


def lexicon_of(parts: tuple) -> Lexicon:
    """The lexicon of a broadcast; a worker that does several tasks makes it once."""
    if _LATEST[0] is not parts:
        _LATEST[:] = [parts, Lexicon(*parts)]
    return _LATEST[1]


def softmax(z: np.ndarray) -> np.ndarray:
    """Over rows, in place."""
    if z.size and max(z.max(), -z.min()) > 60:  # exp is safe below
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z *= (1 / (z @ np.ones(z.shape[1], dtype=z.dtype)))[:, None]
    return z


class Window:
    """A table of the parts that words have as left and right neighbours, a softmax over classes, one over each class's members.

    The hidden layer ends with a constant 1, so biases are weights like others. Steps are sized by the squares of the
    gradients that a weight (in near: a row) has met so far, so what is met seldom moves as far as what is common.
    """

    def __init__(self, lexicon: Lexicon):
        rng = np.random.default_rng(SEED)
        self.lexicon, m, classes = lexicon, lexicon.members, lexicon.rare_class + 1
        self.near = rng.normal(0, 0.3, (lexicon.rows + 1, 2 * WIDTH)).astype(np.float32)  # as a left neighbour, as a right one
        self.out = np.zeros((WIDTH + 1, classes), dtype=np.float32)
        self.inner = np.zeros((classes, WIDTH + 1, m), dtype=np.float32)
        of = lexicon.prior.sum(axis=1)
        self.out[-1] = np.log(of / of.sum())
        self.inner[:, -1] = np.log(lexicon.prior / of[:, None])
        self.seen = {"near": np.full((lexicon.rows + 1, 1), START, dtype=np.float32), "out": np.full_like(self.out, START), "inner": np.full_like(self.inner, START)}

    def rows(self) -> dict[str, np.ndarray]:
        """The weights as tables with a row for each neighbour, class and member."""
        return {"near": self.near, "out": self.out.T, "inner": self.inner.swapaxes(1, 2).reshape(-1, WIDTH + 1)}

    def take(self, rows: dict[str, np.ndarray]) -> Window:
        self.near, self.out = rows["near"], np.ascontiguousarray(rows["out"].T)
        self.inner = np.ascontiguousarray(rows["inner"].reshape(len(self.inner), -1, WIDTH + 1).swapaxes(1, 2))
        return self

    def hidden(self, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows from the first position's neighbours to the last's, where the positions are among them, and their hidden layer."""
        span, where = rows[at[0] - SIDE : at[-1] + SIDE + 1], at - at[0]
        near, n = self.near[span], len(span) - 2 * SIDE
        left, right = near[:, :WIDTH], near[:, WIDTH:]
        h = np.zeros((n, WIDTH), dtype=np.float32)
        for d in range(1, SIDE + 1):
            h += (left[SIDE - d : SIDE - d + n] + right[SIDE + d : SIDE + d + n]) / np.float32(d)
        out = np.ones((len(at), WIDTH + 1), dtype=np.float32)
        np.tanh(h[where], out=out[:, :-1])
        return span, where, out

    def members(self, h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """p(member | class, both sides) for positions sorted by class; (class, from, to) of each class that occurs."""
        ends = np.cumsum(np.bincount(of, minlength=len(self.inner)))
        parts = [(c, int(ends[c - 1]) if c else 0, int(ends[c])) for c in np.flatnonzero(np.diff(ends, prepend=0)).tolist()]
        z = np.empty((len(h), self.lexicon.members), dtype=np.float32)
        for c, a, b in parts:
            np.matmul(h[a:b], self.inner[c], out=z[a:b])
        return softmax(z), parts

    def step(self, rows: np.ndarray, of: np.ndarray, member: np.ndarray, at: np.ndarray) -> None:
        """One step of gradient descent on the positions at, whose words have these classes and members."""
        order = np.argsort(of, kind="stable")
        span, where, h = self.hidden(rows, at)
        h, of, member, where, every = h[order], of[order], member[order], where[order], np.arange(len(at))
        e = softmax(h @ self.out)
        e[every, of] -= 1
        back, out = e @ self.out.T, h.T @ e
        e, parts = self.members(h, of)
        e[every, member] -= 1
        inner = np.empty((len(parts), *self.inner.shape[1:]), dtype=np.float32)
        for k, (c, a, b) in enumerate(parts):
            back[a:b] += e[a:b] @ self.inner[c].T
            np.matmul(h[a:b].T, e[a:b], out=inner[k])
        h = h[:, :-1]
        back = back[:, :-1] * (1 - h * h)
        self.seen["out"] += out * out
        self.out -= RATE * out / np.sqrt(self.seen["out"])
        touched = [c for c, _, _ in parts]
        self.seen["inner"][touched] += inner * inner
        self.inner[touched] -= RATE * inner / np.sqrt(self.seen["inner"][touched])
        # What positions send back to their neighbours, summed for each row of the table.
        sent, at_place = np.zeros((len(span), 2 * WIDTH), dtype=np.float32), np.zeros((len(span), WIDTH), dtype=np.float32)
        at_place[where + SIDE] = back
        for d in range(1, SIDE + 1):
            sent[:-d, :WIDTH] += at_place[d:] / np.float32(d)
            sent[d:, WIDTH:] += at_place[:-d] / np.float32(d)
        order = np.argsort(span, kind="stable")
        there = span[order]
        starts = np.flatnonzero(np.concatenate(([True], there[1:] != there[:-1])))
        sums, there = np.add.reduceat(sent[order], starts, axis=0), there[starts]
        seen = self.seen["near"][there] + np.einsum("ij,ij->i", sums, sums)[:, None] / sums.shape[1]
        self.seen["near"][there] = seen
        self.near[there] -= RATE * sums / np.sqrt(seen)

    def log_probabilities(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        out, lexicon = np.empty(len(at)), self.lexicon
        rows = lexicon.row[codes]
        for k in range(0, len(at), CHUNK):
            a = at[k : k + CHUNK]
            order = np.argsort(lexicon.of[codes[a]], kind="stable")
            words = codes[a][order]
            h, of, every = self.hidden(rows, a)[2][order], lexicon.of[words], np.arange(len(a))
            p = softmax(h @ self.out)[every, of].astype(np.float64) * self.members(h, of)[0][every, lexicon.member[words]]
            out[k + order] = np.log(np.maximum(p, 1e-60)) + lexicon.within[words]
        return out


def trained(docs: DataFrame) -> tuple[tuple, dict[str, np.ndarray], DataFrame]:
    """What makes the lexicon, the averaged tables, and (word, log_share) of the words that are not broadcast."""
    spark = tuned(docs.sparkSession)
    counts = written(counted(docs), "word-counts")
    band = F.floor(F.log2("n") * 8)
    # A few hundred bands at most, whatever the corpus; a band is broadcast whole or not at all.
    size, least = 0, None
    for b, n in sorted(((r["b"], r["n"]) for r in counts.groupBy(band.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True):
        if size + n > LEXICON:
            break
        size, least = size + n, b
    common = F.lit(False) if least is None else band >= least
    found = counts.where(common).toArrow()
    ranked = sorted(zip(found.column("n").to_pylist(), found.column("word").to_pylist()), key=lambda x: (-x[0], x[1]))
    words, times = [w for _, w in ranked], np.array([n for n, _ in ranked], dtype=np.float64)
    totals = np.zeros(MEMBERS)
    for r in counts.groupBy(group_column(F.col("word")).alias("g")).agg(F.sum("n").alias("n")).collect():
        totals[r["g"]] = r["n"]
    for w, n in zip(words[:HEAD], times[:HEAD]):
        totals[group(w)] -= n
    parts = (words, times, totals, HEAD, MEMBERS, RARE_ROWS)
    shared = spark.sparkContext.broadcast(parts)

    def run(batches):
        import pyarrow as pa

        lexicon, shard, net = None, None, None

        def learned():
            """The tables of the shard that ends here, with how often it has met each row."""
            if net is None or not steps:
                return
            met = {"near": near, "out": np.full(len(classes), steps), "inner": np.repeat(classes, lexicon.members)}
            for name, table in net.rows().items():
                rows = np.flatnonzero(met[name])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(rows, type=pa.int64()), pa.array(met[name][rows], type=pa.int64()), pa.array(list(table[rows]), type=pa.list_(pa.float32()))], names=["name", "row", "weight", "v"])

        for batch in batches:
            shards_here = batch.column("shard").to_numpy()
            for low, high in zip(cuts := np.flatnonzero(np.diff(shards_here, prepend=-1)), [*cuts[1:], len(shards_here)]):
                if shards_here[low] != shard:
                    yield from learned()
                    lexicon = lexicon_of(shared.value)
                    shard, net, steps = shards_here[low], Window(lexicon), 0
                    near, classes = np.zeros(lexicon.rows + 1, dtype=np.int64), np.zeros(lexicon.rare_class + 1, dtype=np.int64)
                codes, at = lexicon.codes(Words(batch.column("text").slice(low, high - low)))
                rows, of, member = lexicon.row[codes], lexicon.of[codes], lexicon.member[codes]
                near += np.bincount(rows, minlength=len(near))
                classes += np.bincount(of[at], minlength=len(classes))
                for k in range(0, len(at), STEP):
                    a = at[k : k + STEP]
                    net.step(rows, of[a], member[a], a)
                    steps += 1
        yield from learned()

    # Which texts train together, and in which order, follows from their hashes and the number of words, not from how the
    # input is split: more machines or files leave the model as it is.
    shards = max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // SHARD_WORDS))
    place = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    texts = docs.select("text", place.alias("place"), F.pmod(place, F.lit(shards)).alias("shard")).where(F.col("text").isNotNull())
    # More partitions than shards, so that seldom two shards meet in one.
    sent = texts.repartition(4 * shards, "shard").sortWithinPartitions("shard", "place").select("shard", "text").mapInArrow(run, "name string, row long, weight long, v array<float>")
    share = F.col("weight").cast("double")
    means = sent.groupBy("name", "row").agg(F.array(*[F.sum(F.get("v", F.lit(k)) * share) / F.sum(share) for k in range(2 * WIDTH)]).alias("v"))
    tables = {name: table.copy() for name, table in Window(Lexicon(*parts)).rows().items()}
    # The size of the network in rows, whatever the corpus.
    for r in means.toLocalIterator():
        tables[r["name"]][r["row"]] = r["v"][: tables[r["name"]].shape[1]]
    log_total = F.array(*[F.lit(float(x)) for x in np.log(totals + 1)])
    return parts, tables, counts.where(~common).select("word", (F.log("n") - F.get(log_total, group_column(F.col("word")))).alias("log_share"))


def scored(docs: DataFrame, model: tuple[tuple, dict[str, np.ndarray], DataFrame]) -> DataFrame:
    """(doc_id, n_words, log_probability, mean): a row for each document."""
    parts, tables, others = model
    shared = docs.sparkSession.sparkContext.broadcast((parts, tables))

    def run(batches):
        import pyarrow as pa

        parts, tables = shared.value
        net = Window(lexicon := lexicon_of(parts)).take(tables)
        for batch in batches:
            words = Words(batch.column("text"))
            codes, at = lexicon.codes(words)
            sums = np.concatenate(([0.0], np.cumsum(net.log_probabilities(codes, at))))
            ends = np.cumsum(words.counts)
            total = sums[ends] - sums[ends - words.counts]
            rare = np.flatnonzero(codes[at] >= lexicon.size)
            offsets = np.concatenate(([0], np.searchsorted(rare, ends)))
            others = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), words.dictionary.take(pa.array(words.index[rare])).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(words.counts, type=pa.int64()), pa.array(total, type=pa.float64()), others], names=["row", "doc_id", "n_words", "sum", "others"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(numbered.mapInArrow(run, "row long, doc_id long, n_words long, sum double, others array<binary>"), "lm-scores")
    least = F.coalesce("log_share", F.lit(-math.log(float(parts[2].sum()) + 1)))  # of a word that training has not met
    added = rows.select("row", F.explode("others").alias("word")).join(others, "word", "left").groupBy("row").agg(F.sum(least).alias("added"))
    total = F.col("sum") + F.coalesce("added", F.lit(0.0))
    return rows.join(added, "row", "left").select("doc_id", "n_words", total.alias("log_probability"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean"))


def report(docs: DataFrame) -> DataFrame:
    return scored(docs, trained(docs))
