import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lectern.llm import common, lm_scoring

KIND = "doc_id long, text string"


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{k}{rng.choice(['ing', 'ed', 'é', ''])}" for k in range(600)]
    return [(i, " ".join(vocabulary[min(int(rng.expovariate(0.01)), 599)] for _ in range(80))) for i in range(120)]


def words(texts):
    import pyarrow as pa

    return common.Words(pa.array(texts, type=pa.string()))


def test_words_of_texts():
    texts = [None, "", " \t\n", "A b\x0bB\x0c ÉÉ c\r\n", "x\x1cy\u2003z b"]
    got = words(texts)
    assert got.counts.tolist() == [0, 0, 0, 5, 2]
    assert [got.distinct[i].decode() for i in got.index] == ["a", "b", "b", "ÉÉ", "c", "x\x1cy\u2003z", "b"]
    assert dict(zip(got.distinct, got.times().tolist()))[b"b"] == 3
    assert words([None]).counts.tolist() == [0] and words([]).distinct == []


def test_all_positions_are_trained(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "STEP", 16)
    text = " ".join(f"word{k}" for k in range(16))
    parts, tables, _ = lm_scoring.trained(spark.createDataFrame([(k, text) for k in range(40)], KIND).coalesce(1))
    lexicon = lm_scoring.Lexicon(*parts)
    start = lm_scoring.Window(lexicon).near
    rows = lexicon.row[[lexicon[w.encode()] for w in text.split()]]
    w = lm_scoring.WIDTH
    assert all((tables["near"][r, :w] != start[r, :w]).any() for r in rows[:-1])
    assert all((tables["near"][r, w:] != start[r, w:]).any() for r in rows[1:])


def topical(n, seed):
    """Texts whose words tell each other: ten topics with words of their own, so context says which 50 of 500 can come."""
    rng = random.Random(seed)
    topics = [rng.randrange(10) for _ in range(n)]
    return [(i, " ".join(f"t{t}w{min(int(rng.expovariate(0.06)), 49)}" for _ in range(60))) for i, t in enumerate(topics)]


def test_context_beats_a_unigram_on_held_out_text(spark):
    train, held = spark.createDataFrame(topical(3000, 1), KIND).repartition(4), spark.createDataFrame(topical(200, 2), KIND)
    model = lm_scoring.trained(train)
    got = sum(r.log_probability for r in lm_scoring.scored(held, model).collect())
    counts = Counter(w for _, t in topical(3000, 1) for w in t.split())
    plain = sum(math.log(counts[w] / sum(counts.values())) for _, t in topical(200, 2) for w in t.split())
    assert got > 0.9 * plain


def test_scores_by_brute_force(spark, monkeypatch):
    """Each word from the same weights, one at a time, by the formula."""
    monkeypatch.setattr(lm_scoring, "HEAD", 128)
    docs = [*corpus()[:40], (900, "w1 never w2")]
    model = lm_scoring.trained(spark.createDataFrame(docs[:-1], KIND).repartition(2))
    (words_, times, totals, head, members, rare), tables, _ = model
    lexicon = lm_scoring.Lexicon(*model[0])
    place = {w: k for k, w in enumerate(words_)}

    def row(w):
        if w is None:
            return head + rare
        return place[w] if place.get(w, head) < head else head + zlib.crc32(w) % rare

    def log_softmax(z):
        return z - (z.max() + np.log(np.exp(z - z.max()).sum()))

    n = lm_scoring.WIDTH
    got = {r.doc_id: r for r in lm_scoring.scored(spark.createDataFrame(docs, KIND), model).collect()}
    for d, text in docs:
        ws, total = text.encode().lower().split(), 0.0
        for i, w in enumerate(ws):
            pre = np.zeros(n)
            for k in (1, 2):
                pre += (tables["near"][row(ws[i - k] if i >= k else None), :n] + tables["near"][row(ws[i + k] if i + k < len(ws) else None), n:]) / k
            h = np.append(np.tanh(pre), 1)
            rank = place.get(w, head)
            c, m = (rank // members, rank % members) if rank < head else (lexicon.rare_class, lm_scoring.group(w))
            total += log_softmax(tables["out"] @ h)[c] + log_softmax(tables["inner"][c * members : (c + 1) * members] @ h)[m]
            if rank >= head:
                total += math.log((times[place[w]] if w in place else 1) / (totals[m] + 1)) if w in place else -math.log(totals.sum() + 1)
        assert math.isclose(got[d].log_probability, total, rel_tol=1e-4), d


def test_words_of_a_part_of_an_array():
    import pyarrow as pa

    texts = [f"Some words {k} of {k % 7}" for k in range(500)] + [None, ""]
    for low, n in ((0, 502), (300, 202), (7, 1), (501, 1), (10, 0)):
        part = common.Words(pa.array(texts, pa.string()).slice(low, n))
        assert [part.distinct[k].decode() for k in part.index] == [w.lower() for t in texts[low : low + n] for w in (t or "").split()]
        assert part.counts.tolist() == [len((t or "").split()) for t in texts[low : low + n]]


@pytest.mark.parametrize("words", [1 << 20, 20_000])
def test_the_input_split_does_not_matter(spark, monkeypatch, words):
    """The same scores for 1, 4 and 16 tasks, with one shard and with several."""
    monkeypatch.setattr(lm_scoring, "SHARD_WORDS", words)
    rng = random.Random(8)
    topics = [[f"t{t}w{k}" for k in range(40)] for t in range(6)]
    docs = [(i, " ".join(rng.choice(topics[i % 6]) for _ in range(60))) for i in range(1200)]
    found = []
    for parts in (1, 4, 16):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
        found.append({r.doc_id: r["mean"] for r in lm_scoring.report(df).collect()})
    assert all(max(abs(found[0][k] - x[k]) for k in x) < 1e-6 for x in found[1:])


def test_words_of_one_hash_have_their_own_counts(spark):
    places = defaultdict(list)
    for k in range(100_000):
        places[zlib.crc32(b"q%d" % k) & 16383].append(f"q{k}")
    often, once = next(v for v in places.values() if len(v) > 1)[:2]
    docs = [*[(k, f"a {often} b") for k in range(200)], (200, f"a {once} b"), (201, f"a {often} b")]
    got = {r.doc_id: r.log_probability for r in lm_scoring.report(spark.createDataFrame(docs, KIND)).collect()}
    assert got[201] - got[200] > 1


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    lexicon_words = ["w%d" % k for k in range(500)]
    counts = np.sort(rng.integers(1, 900, 500))[::-1].astype(float)
    totals = np.zeros(64)
    for w, n in zip(lexicon_words[128:], counts[128:]):
        totals[lm_scoring.group(w.encode())] += n
    lexicon = lm_scoring.Lexicon([w.encode() for w in lexicon_words], counts, totals, 128, 64, 256)
    net = lm_scoring.Window(lexicon)
    net.out[:-1] = rng.normal(0, 1, net.out[:-1].shape)
    net.inner[:, :-1] = rng.normal(0, 1, net.inner[:, :-1].shape)
    texts = [" ".join(("w3", "w4", f"w{k}", "w300", "w6")) for k in range(500)]
    order = [int(w[1:]) for w in lexicon_words]
    codes, at = lexicon.codes(words([texts[k] for k in order]))
    total = np.exp(net.log_probabilities(codes, at)[2::5]).sum()
    h = net.hidden(lexicon.row[codes], at[2:3])[2]
    unmet = lm_scoring.softmax(h @ net.out)[0, -1] * lm_scoring.softmax(h @ net.inner[-1])[0] / (totals + 1)
    assert abs(total + unmet.sum() - 1) < 1e-4


def test_words_beyond_the_broadcast_score_the_same(spark, monkeypatch):
    df = spark.createDataFrame([*corpus(), (7, None), (None, "w1 neverelse"), (None, "w1 neverelse")], KIND).repartition(3, "text").cache()
    monkeypatch.setattr(lm_scoring, "HEAD", 64)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words)
    whole = sorted(lm_scoring.report(df).collect(), key=key)
    monkeypatch.setattr(lm_scoring, "LEXICON", 100)
    model = lm_scoring.trained(df)
    assert len(model[0][0]) <= 100 and model[2].count() > 300
    some = sorted(lm_scoring.scored(df, model).collect(), key=key)
    assert len(some) == len(whole) == 123
    for a, b in zip(whole, some):
        assert (a.doc_id, a.n_words) == (b.doc_id, b.n_words) and math.isclose(a.log_probability, b.log_probability, rel_tol=1e-3, abs_tol=1e-6)


def test_counts_are_of_all_words(spark):
    got = {bytes(r.word): r.n for r in lm_scoring.counted(spark.createDataFrame(corpus(), KIND).repartition(4)).collect()}
    assert got == Counter(w for _, t in corpus() for w in t.encode().lower().split())
