"""Benchmark decontamination with one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised to lower-case words joined by single spaces; a pattern is a window of 10 item words between spaces.
Each text is scanned once; matches are mapped to words and to code points of the original text.

The automaton is broadcast, so its size is checked before anything is collected: items whose patterns exceed
PATTERN_CHARS are dealt by hash to several automata. Each then scans the texts for itself; only what it finds is kept, by
a hash of the text, and put together at the end, so no text is written again.

Edge cases: null, empty or word-free texts have no words and no hit; such items have no window. Items of fewer than 10
words are one window. A window that several items share counts for each; repeated rows of an item count once, and a null
item id is written as an empty string. Repeated documents are scanned and returned each. Extra columns pass through: what
is found lies in one struct column, whose name must be free; clean() chooses one.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tuned, unused, written

HITS = "__hits"
WINDOW = 10
#: Characters of all patterns of one automaton at most: about 100 bytes of memory each in the worst case.
PATTERN_CHARS = 2_000_000
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FLAT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: The automaton that this worker built last, by the name of its broadcast: tasks of one worker share it.
_BUILT: dict = {}
HIT_TYPE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("ranges", T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("first", "last", "start", "end")]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def flat_words(text: bytes | None) -> bytes:
    """The words, joined by single spaces, as UTF-8."""
    return b" ".join((text or b"").translate(_FLAT).split())


def windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (window, item): the window as its bytes read as Latin-1, with a space at both ends."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out: list[tuple[str, str]] = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                found = flat_words(text).decode("latin-1").split(" ")
                if found != [""]:
                    out += {(f" {' '.join(found[k : k + WINDOW])} ", item) for k in range(max(1, len(found) - WINDOW + 1))}
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], type=pa.string()) for i in (0, 1)], names=["window", "item"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    return items.mapInArrow(run, "window string, item string").distinct()


def scanned(docs: DataFrame, benchmark: DataFrame, pattern_chars: int = PATTERN_CHARS, name: str = HITS) -> DataFrame:
    """docs with a struct of this name: the number of words, the word and code point ranges of found windows, the items they come from."""
    tuned(docs.sparkSession)
    pairs = written(windows(benchmark), "windows")
    # An item's id takes room for each of its windows; so both are counted.
    size = pairs.agg(F.sum(F.length("window") + F.length("item"))).first()[0] or 0
    n = max(1, math.ceil(size / pattern_chars))
    if n == 1:
        return _scan(docs, _patterns(pairs), name)
    found = None
    key = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    for k in range(n):
        hits = _scan(docs.select("text"), _patterns(pairs.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k)), HITS)
        some = hits.where(F.size(f"{HITS}.ranges") > 0).select(key.alias("key"), HITS).groupBy("key").agg(F.first(HITS).alias("h"))
        some = written(some, "hits")
        found = some if found is None else found.unionByName(some)
    merged = found.groupBy("key").agg(F.flatten(F.collect_list("h.ranges")).alias("ranges"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("h.items")))).alias("items"))
    (mark,) = unused(docs, "key")
    whole = _scan(docs, _patterns(pairs.limit(0)), name).withColumn(mark, key)
    joined = whole.join(merged.withColumnRenamed("key", mark).withColumnRenamed("ranges", mark + "_ranges").withColumnRenamed("items", mark + "_items"), mark, "left")
    empty = F.col(f"{name}.ranges")
    struct = F.struct(F.col(f"{name}.n_words").alias("n_words"), F.coalesce(mark + "_ranges", empty).alias("ranges"), F.coalesce(mark + "_items", F.col(f"{name}.items")).alias("items"))
    return joined.select(*[f"`{c}`" for c in docs.columns], struct.alias(name))


def _patterns(pairs: DataFrame):
    """(name, window -> items), broadcast; its size was checked before."""
    by_window: dict[str, list[str]] = {}
    for r in pairs.toLocalIterator():
        by_window.setdefault(r["window"], []).append(r["item"])
    return pairs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, by_window))


def _automaton(name: str, by_window: dict[str, list[str]]):
    import ahocorasick

    if name not in _BUILT:
        automaton = ahocorasick.Automaton()
        for window, items in by_window.items():
            automaton.add_word(window, (window.count(" ") - 1, items))
        automaton.make_automaton()
        _BUILT.clear()
        _BUILT[name] = automaton if len(automaton) else None
    return _BUILT[name]


def hits_of(text: bytes | None, automaton) -> dict:
    """HIT_TYPE of one text."""
    import numpy as np

    flat = flat_words(text)
    found = list(automaton.iter(f" {flat.decode('latin-1')} ")) if automaton is not None and flat else []
    ranges, items = [], set()
    if found:
        spaces = np.flatnonzero(np.frombuffer(flat, dtype=np.uint8) == 32) + 1
        lasts = np.searchsorted(spaces, [end for end, _ in found], side="left").tolist()
        # Normalising keeps the length in bytes, so words lie where they lay; code points are bytes that do not go on another.
        spans = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FLAT))]
        points = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
        for last, (_, (length, of)) in zip(lasts, found):
            first = last - length + 1
            ranges.append({"first": first, "last": last, "start": int(points[spans[first][0]]), "end": int(points[spans[last][1]])})
            items.update(of)
    return {"n_words": flat.count(b" ") + 1 if flat else 0, "ranges": ranges, "items": sorted(items)}


def _scan(docs: DataFrame, patterns, name: str) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        automaton = _automaton(*patterns.value)
        ranges = pa.list_(pa.struct([(x, pa.int64()) for x in ("first", "last", "start", "end")]))
        kind = pa.struct([("n_words", pa.int64()), ("ranges", ranges), ("items", pa.list_(pa.string()))])
        for batch in batches:
            hits = [hits_of(text, automaton) for text in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hits, type=kind)], names=[*batch.schema.names[:-1], name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, HIT_TYPE)])
    return docs.select("*", F.col("text").cast("binary").alias(name)).mapInArrow(run, schema)


def n_hit(ranges) -> F.Column:
    """How many words lie in any of the ranges, whose lengths may differ."""
    ordered = F.array_sort(ranges)
    return F.aggregate(
        ordered,
        F.struct(F.lit(-1).cast("long").alias("to"), F.lit(0).cast("long").alias("n")),
        lambda a, r: F.struct(F.greatest(a["to"], r["last"]).alias("to"), (a["n"] + F.greatest(r["last"] - F.greatest(a["to"] + 1, r["first"]) + 1, F.lit(0))).alias("n")),
        lambda a: a["n"],
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = scanned(docs.select("doc_id", "text"), benchmark)
    n = n_hit(F.col(f"{HITS}.ranges"))
    return found.select(
        "doc_id",
        F.col(f"{HITS}.n_words").alias("n_words"),
        n.alias("n_hit"),
        F.size(f"{HITS}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{HITS}.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(f"{HITS}.ranges") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, unchanged."""
    (name,) = unused(docs, HITS)
    return scanned(docs, benchmark, name=name).where(F.size(f"{name}.ranges") == 0).drop(name)


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
