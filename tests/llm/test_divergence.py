"""Source divergence against a plain version and against SQL; the quadtree against all cells."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from lectern.llm import divergence, queries

KIND = "doc_id long, text string, lang string, source string"


def plain(docs, top=200):
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(words)
        seen[lang].update(set(words))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [w for w, n in seen[lang].items() if n >= 3]
        total = {w: sum(counts[lang, s][w] for s in sources) for w in kept}
        size = {s: sum(counts[lang, s][w] for w in kept) for s in sources}
        p = {s: {w: 1 + 10**9 * (counts[lang, s][w] + 1) // (size[s] + len(kept)) for w in kept} for s in sources}
        q = {w: 1 + 10**9 * (total[w] + 1) // (sum(size.values()) + len(kept)) for w in kept}
        for s in sources:
            pairs = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o) for o in sources if o != s]
            own = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, rows in (("pair", pairs), ("term", own)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(rows) if part == "pair" or k < top}
    return out


def corpus(seed, many, sources, vocabulary):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcéßЖ中Z") for _ in range(rng.randint(1, 5))) for _ in range(vocabulary)]
    docs = []
    for i in range(many):
        lang, source = rng.choice(["en", "de", "", None]), f"s{min(rng.randrange(sources), rng.randrange(sources))}"
        docs.append((i, rng.choice([" ", "-", "1 "]).join(rng.choice(words[: rng.randint(1, vocabulary)]) for _ in range(rng.randint(0, 60))), lang, rng.choice([source, source, None])))
    return docs + [(1, "Word word WORD", "one", "a")] * 3 + [(2, None, "none", "a"), (3, "", "none", None), (4, "...", "none", "b")] + docs[:5]


@pytest.mark.parametrize("block,tile,held", [(2048, 256, 1 << 21), (16, 4, 100)])
def test_plain(spark, block, tile, held):
    """With one block and tile, and with many of both and several rows of a term from each task."""
    docs = corpus(1, 400, 13, 300)
    got = Counter(tuple(r) for r in divergence.report(spark.createDataFrame(docs, KIND).repartition(6), 30, block, tile, held).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == Counter(plain(docs, 30))


def test_quadtree():
    rng = np.random.default_rng(2)
    for groups, terms, share in ((1, 1, 1.0), (3, 70, 0.05), (20, 300, 0.01), (9, 64, 0.5), (17, 33, 0.0)):
        filled = rng.uniform(0, 1, (groups, terms)) < share
        zero = rng.integers(1, 1000, groups)
        p = np.where(filled, rng.integers(1, 10**9, filled.shape), zero[:, None])
        sums, empty = divergence.together(p, filled)
        full = ((p[:, None, :] - p[None, :, :]) ** 2 // p[None, :, :])
        priced = full.sum(axis=2)
        unseen = ((zero[:, None] - zero[None, :]) ** 2 // zero[None, :]) * empty
        assert (sums + unseen == priced).all()
        assert (empty <= (~filled[:, None, :] & ~filled[None, :, :]).sum(axis=2)).all()
        if share == 0.0:
            assert (empty == terms).all()


def test_none_and_clashing_names(spark):
    assert divergence.report(spark.createDataFrame([], KIND)).collect() == []
    rows = [(1, "a b", "en", "x", "t", 1)] * 3 + [(1, "a b c", "en", "y", "t", 1)]
    got = divergence.report(spark.createDataFrame(rows, KIND + ", term string, rank int")).select("lang", "source", "part", "item", "value", "rank").collect()
    assert Counter(map(tuple, got)) == Counter(plain([r[:4] for r in rows]))


def test_with_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(queries.oracle_sql()["op13_source_divergence"])
    got = queries.op13_source_divergence(spark, sf)
    assert Counter(tuple(r) for r in got.select(*want.columns).collect()) == Counter(want.fetchall())
