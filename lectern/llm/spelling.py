"""Spelling variants: words that differ by one letter, and the frequent form that each rare one leads to.

Words are counted over all texts, then meet in buckets. Of two words one edit apart, all but one of three pieces agree, so
each word goes to a bucket for each piece left out (by the length of the shorter word, its own or one less). A bucket with
more than HOT words is dealt anew with pieces of one letter; of those, none can hold more words than the alphabet allows
(88 letters: 88 of the shorter length and 88 * 88 of the longer), so what a task holds has a proven bound.

Within a bucket there is a bit-sliced position index: for each position and letter a bitset of the words that have it
there. A query word reads its letters one after the other and keeps four sets, 64 words at a time: no error so far, one
letter replaced, one letter of the query left out (the index is read one position back) or one letter added (one position
ahead). A pair counts in one bucket only: that of the first piece without which it agrees. Each word leaves a bucket as one
row, with the number of its near words and the best of them, so pairs are never written.

Edge cases: null and empty texts have no words. A doc_id of null is an empty string in the hash. Repeated rows are counted
each. Ties of frequency go to the smaller word in code-point order. Very long words are compared in smaller blocks. No rows,
no words. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tuned, written

#: Runs of letters, of which only A-Z are lower-cased; one in DROP_ONE occurrences, by hash, has a letter deleted.
RUN, UPPER, DROP_ONE = "[A-Za-zÀ-ÿ]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 199
LEAST_LETTERS, LEAST_TIMES, STRONGER = 6, 5, 5
PIECES = 3
#: Words of a bucket beyond which it is dealt anew, words of a block that is compared at once, and letters of a block.
HOT, BLOCK_WORDS, BLOCK_LETTERS = 4096, 1024, 1 << 20


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts with their occurrences, those with few of them left out."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    run = run.where(F.char_length("run") >= LEAST_LETTERS)
    # Most runs are lower case already, which is cheaper to see than to make.
    low = run.select("id", F.when(F.col("run") == F.lower("run"), F.col("run")).otherwise(F.translate("run", UPPER, UPPER.lower())).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(F.col("h") % DROP_ONE == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_TIMES)


def _keyed(word: Column, m: Column, low: Column, high: Column) -> Column:
    """Where a word meets those that agree with it but for letters low to high of the shorter word's m."""
    rest = F.concat(F.substring(word, F.lit(1), low), F.lit("\n"), F.substring(word, F.char_length(word) - (m - high) + 1, m - high))
    return F.struct(m.alias("m"), low.alias("low"), high.alias("high"), F.xxhash64(m, low, high, rest).alias("bucket"))


def bucketed(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n, m, low, high, bucket) for words (word, n): near words share exactly one bucket in which they count."""
    size = F.char_length("word")
    shorter = words.select("word", "n", F.explode(F.filter(F.array(size, size - 1), lambda m: m >= LEAST_LETTERS)).alias("m"))
    part = lambda k: F.floor(F.col("m") * k / PIECES).cast("int")
    keys = shorter.select("word", "n", F.explode(F.array(*[_keyed(F.col("word"), F.col("m"), part(k), part(k + 1)) for k in range(PIECES)])).alias("key")).select("word", "n", "key.*")
    # One short row for each hot bucket, of which there are at most rows / hot: Spark sees its size and joins as that allows.
    large = written(keys.groupBy("bucket").count().where(F.col("count") > hot).select("bucket", F.lit(True).alias("large")), "hot-buckets")
    told = keys.join(large, "bucket", "left")
    fine = F.transform(F.sequence(F.col("low"), F.col("high") - 1), lambda t: _keyed(F.col("word"), F.col("m"), t, t + 1))
    same = F.array(F.struct("m", "low", "high", "bucket"))
    return told.select("word", "n", F.explode(F.when(F.col("large"), fine).otherwise(same)).alias("key")).select("word", "n", "key.*")


class Index:
    """The bit-sliced position index of some words (rows of letter codes, -1 beyond their ends)."""

    def __init__(self, letters, alphabet: int):
        import numpy as np

        self.alphabet, self.n = alphabet, len(letters)
        row, at = np.nonzero(letters >= 0)
        self.keys, inverse = np.unique(at * alphabet + letters[row, at], return_inverse=True)
        flags = np.zeros((len(self.keys) + 1, -(-self.n // 64) * 64), dtype=bool)
        flags[inverse, row] = True
        self.bits = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)  # the last row is empty
        sizes = (letters >= 0).sum(axis=1)
        self.of_size = lambda m: np.packbits(np.pad(sizes == m, (0, flags.shape[1] - self.n)), bitorder="little").view(np.uint64)

    def rows(self, letters, shift: int):
        """For each letter of each query, the number of the bitset of words that have it so many positions further on."""
        import numpy as np

        want = (np.arange(letters.shape[1]) + shift) * self.alphabet + letters
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((self.keys[at] == want) & (want >= 0), at, len(self.keys))

    def near(self, letters, m: int):
        """(query, word) numbers one edit apart whose shorter one has m letters; all queries have the same length, m or m + 1."""
        import numpy as np

        here, ahead, back = (self.rows(letters, s) for s in (0, 1, -1))
        none = np.full((len(letters), self.bits.shape[1]), ~np.uint64(0))
        replaced, left_out, added = (np.zeros_like(none) for _ in range(3))
        longer = letters.shape[1] > m
        for i in range(letters.shape[1]):
            same = self.bits[here[:, i]]
            if longer:
                left_out = left_out & self.bits[back[:, i]] | none
            else:
                replaced = replaced & same | none & ~same
                added = (added | none) & self.bits[ahead[:, i]]
            none = none & same
        hit = left_out & self.of_size(m) if longer else replaced & self.of_size(m) | (added | none) & self.of_size(m + 1)
        query = np.nonzero(hit.any(axis=1))[0]
        k, word = np.nonzero(np.unpackbits(hit[query].view(np.uint8), axis=1, bitorder="little", count=self.n))
        return query[k], word


def _block(words, n, low, high, m: int):
    """(word number, near words, n of the best, number of the best) within rows of buckets of one m; each pair in its own piece."""
    import numpy as np

    text = np.array(words)
    size = np.char.str_len(text)
    points = text.view(np.uint32).reshape(len(text), -1)
    alphabet, codes = np.unique(points, return_inverse=True)
    letters = np.where(np.arange(points.shape[1]) < size[:, None], codes.reshape(points.shape), -1)
    tail = points[np.arange(len(text))[:, None], size[:, None] - 1 - np.arange(m)]  # the last m letters, from the end
    place = np.empty(len(text), dtype=np.int64)
    place[np.argsort(text, kind="stable")] = np.arange(len(text))
    found = []
    step = max(1, min(BLOCK_WORDS, BLOCK_LETTERS // m))
    for a in range(0, len(text), step):
        index = Index(letters[a : a + step], len(alphabet))
        for b in range(0, len(text), step):
            for length in (m, m + 1):
                rows = b + np.nonzero(size[b : b + step] == length)[0]
                if len(rows):
                    query, word = index.near(letters[rows, :length], m)
                    query, word = rows[query], word + a
                    alike = (low[query] == low[word]) & (high[query] == high[word])
                    query, word = query[alike], word[alike]
                    differs = tail[query] != tail[word]
                    first = np.maximum(1, m - np.where(differs.any(axis=1), differs.argmax(axis=1), m))
                    own = (low[query] < first) & (first <= high[query])
                    found.append((query[own], word[own]))
    query, word = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((place[word], -n[word], query))
    query, word = query[order], word[order]
    rows, first, count = np.unique(query, return_index=True, return_counts=True)
    return rows, count, n[word[first]], word[first]


def _near(batches):
    """Rows sorted by m, low, high and bucket in, a row for each word and block that has near words out."""
    import numpy as np
    import pyarrow as pa

    def keys(t):
        return np.stack([t[c].to_numpy() for c in ("m", "low", "high", "bucket")], axis=1).astype(np.int64)

    def blocks(t):
        """Whole buckets of two or more words, as many at once as a block holds, all of one m."""
        k = keys(t)
        starts = np.r_[0, np.nonzero((k[1:] != k[:-1]).any(axis=1))[0] + 1]
        sizes = np.diff(np.r_[starts, len(k)])
        kept = sizes > 1
        rows, sizes, ms = np.nonzero(np.repeat(kept, sizes))[0], sizes[kept], k[starts[kept], 0]
        at = done = 0
        held = 0
        for i, (size, m) in enumerate(zip(sizes.tolist(), ms.tolist())):
            if held and (m != ms[i - 1] or (held + size) > min(BLOCK_WORDS, max(2, BLOCK_LETTERS // m))):
                yield rows[done:at], int(ms[i - 1]), k
                done, held = at, 0
            at, held = at + size, held + size
        if held:
            yield rows[done:at], int(ms[-1]), k

    def run(t):
        for rows, m, k in blocks(t):
            part = t.take(pa.array(rows))
            words = part["word"].to_pylist()
            row, count, best_n, best = _block(words, part["n"].to_numpy(), k[rows, 1], k[rows, 2], m)
            if len(row):
                yield pa.RecordBatch.from_pydict({"word": [words[i] for i in row], "n_near": count.astype(np.int64), "best_n": best_n, "best": [words[i] for i in best]}, schema=schema)

    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    carry = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if carry is None else pa.concat_tables([carry, t])
        if not len(t):
            continue
        k = keys(pa.table({c: t[c] for c in ("m", "low", "high", "bucket")}))
        last = len(k) - int(np.argmax((k[::-1] != k[-1]).any(axis=1))) if (k != k[-1]).any() else 0
        if last:
            yield from run(t.slice(0, last).combine_chunks())
        carry = t.slice(last)
    if carry is not None and len(carry):
        yield from run(carry.combine_chunks())


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n_near, near_n, near): of each word (word, n) that has near ones, how many, and the most frequent of them."""
    tuned(words.sparkSession)
    rows = bucketed(words, hot).repartition("bucket").sortWithinPartitions("m", "low", "high", "bucket")
    parts = rows.mapInArrow(_near, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    found = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less")).alias("near_n"), F.col("b.best").alias("near"))


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where forms lead in the end. Each round doubles the steps taken; a form is at least
    five times as frequent as its word, so chains are short."""
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        steps = written(steps.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        moved = not steps.where("moved").isEmpty()
        steps = steps.drop("moved")
        if not moved:
            return steps


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the texts."""
    words = written(vocabulary(docs), "vocabulary")
    strong = F.col("near_n") >= STRONGER * F.col("n")
    joined = words.join(near_words(words), "word", "left")
    formed = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(strong, F.col("near")).alias("form"), F.when(strong, F.col("near_n")).alias("form_n")), "forms")
    roots = rooted(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
