"""Spelling variants against a plain version that compares all pairs."""

import random
import zlib
from collections import Counter

import duckdb
import pytest
from lectern.llm import queries, spelling

KIND = "doc_id long, text string"


def runs(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
            word += c.lower() if "A" <= c <= "Z" else c
        elif word:
            out.append(word)
            word = ""
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs):
    n = Counter()
    for i, text in docs:
        for r in runs(text):
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 199 == 0:
                k = h % len(r)
                r = r[:k] + r[k + 1 :]
            n[r] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) if near[w] else None for w in n}
    form = {w: b if b and n[b] >= 5 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def found(spark, docs, monkeypatch=None, hot=None):
    df = spark.createDataFrame(docs, KIND).repartition(5)
    if hot is not None:
        real = spelling.bucketed
        monkeypatch.setattr(spelling, "bucketed", lambda words, _=None: real(words, hot))
    return {tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def words(rng, letters, many):
    """Words near one another in chains, of all frequencies, with letters beyond ASCII."""
    out = []
    for _ in range(many):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 9)))
        times = rng.choice([1, 5, 6, 30, 200])
        for _ in range(rng.randint(1, 5)):
            out += [w] * times
            k, c = rng.randrange(len(w)), rng.choice(letters)
            w = rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :], w + c])
            times = max(1, times // rng.choice([1, 2, 5, 6]))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("hot", [None, 1])
def test_all_pairs(spark, monkeypatch, hot):
    """As it is, and with every bucket dealt anew by single letters."""
    rng = random.Random(1)
    texts = []
    for letters, many in (("ab", 60), ("abé", 80), ("ÀÿzZ", 40)):
        w = words(rng, letters, many)
        texts += [", ".join(w[i : i + 90]) for i in range(0, len(w), 90)]
    docs = list(enumerate(texts)) + [(7, None), (None, "Straße abbaba " * 6), (8, ""), (9, "a\n\n-- ×÷×÷×÷ " * 5)]
    want = plain(docs)
    assert found(spark, docs, monkeypatch, hot) == want
    assert sum(w[1] is not None for w in want) > 20 and any(w[1] and w[2] != w[1] for w in want) and max(w[4] for w in want) > 5


def test_long_words_ties_and_repeats(spark):
    long = "xy" * 3000
    docs = [(1, f"{long} {long}z {long[1:]} ")] * 12 + [(2, "aaaaaa aaaaab aaaaac ")] * 5 + [(3, "aaaaaa ")] * 30
    assert found(spark, docs) == plain(docs)
    assert found(spark, [(1, None)]) == set()
    empty = spark.createDataFrame([], "doc_id long, text string, word string, n long")
    assert spelling.variants(empty).collect() == []
    clash = spark.createDataFrame([(1, "common words " * 9, 5, "x")], "doc_id long, text string, n long, word string")
    assert {r.word for r in spelling.variants(clash).collect()} == {"common"}


def test_with_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(queries.oracle_sql()["op11_spelling_variants"])
    got = queries.op11_spelling_variants(spark, sf)
    assert Counter(tuple(r) for r in got.select(*want.columns).collect()) == Counter(want.fetchall())
