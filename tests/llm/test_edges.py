"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import random
import re

import pytest
from lectern.llm import decontamination, html_text, lm_scoring, mixing, pii, quality_classifier, quality_rules, secrets, simhash, warc
from pyspark.sql import functions as F

from . import brute

#: Columns that are named as those that the operators use on their way.
CLASHES = "n_words size fp bucket score spans part source_size target copies taken text_hash component_id root row at p u settled whole __quality __pii __secrets __hits __bytes __id __hash __h __i __t __text_hash __source".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = " ".join(word() for _ in range(300))
    long = "\n".join(" ".join(word() for _ in range(12)) for _ in range(9000)) + " " + "a" * 2000 + " 1" * 30_000 + " AKIA" * 5000
    special = [None, "", " \t\n", text, text, text.replace(" ", "  "), text + " tail", long, "one two", "one two three", "x" * 50, "é" * 30, "a@b.cc " * 40, "0" * 40]
    out = [(k, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None) for k, t in enumerate(special)]
    out += [(3, text, "en", "s3"), (3, text, "en", "s3"), (None, text, "en", "s1"), (None, None, None, None)]
    return [(*r, None if r[1] is None else len(r[1]), *CLASHES) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (3, 1, 0), (4, 1, 1), (4, 0, 1), (7, None, None), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality_rules(docs, none, labels):
    q = "found"
    m = quality_rules.measured(docs, name=q)
    out = quality_rules.judged(m, quality_rules.certified(m, labels, name=q), name=q)
    assert out.drop(q).columns == docs.columns == quality_rules.kept(docs, labels).columns
    assert quality_rules.kept(docs, labels).count() == sum(not brute.quality(r[1])[-1] for r in rows())
    got = out.select("text", f"{q}.*").collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(r.text)
        assert r.kept == (not r.base_failed)  # so few labels certify nothing
    assert quality_rules.kept(none, labels.limit(0)).count() == 0


def test_binomial_tail(spark):
    from math import comb

    cases = [(0, 10, 0.1), (3, 50, 0.02), (17, 400, 0.05), (40, 900, 0.05)]
    for k, n, p in cases:
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k), F.lit(n), p).alias("x")).first().x
        assert got == pytest.approx(sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)), rel=1e-9)


def test_certified_cutoffs_keep_their_promise(spark):
    """Cutoffs certified on one draw reject the bad rows of another, and at most RISK of its good ones; strata apart, null one of them."""
    rng = random.Random(1)

    def draw(first):
        good = [(first + k, " ".join(rng.choice(("alpha", "beta", "gamma")) + str(rng.randint(0, 9999)) for _ in range(60)) + " #" * rng.choice((0, 0, 0, 1, 2)), "en" if k % 3 else None) for k in range(6000)]
        bad = [(first + 6000 + k, " ".join("w" + str(rng.randint(0, 9999)) + "***" for _ in range(60)), "en" if k % 3 else None) for k in range(600)]
        few = [(first + 7000 + k, " ".join("w" + str(rng.randint(0, 9999)) + "***" * (k % 2) for _ in range(60)), "\0") for k in range(100)]
        return good + bad + few

    schema = "doc_id long, text string, lang string"
    labels = spark.createDataFrame([(d, int(d < 6000 or d >= 7000 and d % 2 == 0)) for d in range(7100)], "doc_id long, quality int")
    cutoffs = quality_rules.certified(quality_rules.measured(spark.createDataFrame(draw(0), schema).repartition(8)), labels)
    got = {r.stratum: r for r in cutoffs.collect()}
    assert set(got) == {"en", None}  # 50 good rows are too few
    assert all(r.cutoffs.symbols == quality_rules.RULES["symbols"][r.level - 1] for r in got.values())
    kept = {r.doc_id - 10_000 for r in quality_rules.judged(quality_rules.measured(spark.createDataFrame(draw(10_000), schema)), cutoffs).where(f"{quality_rules.QUALITY}.kept").collect()}
    assert sum(d < 6000 for d in kept) >= 6000 * (1 - quality_rules.RISK)
    assert not any(6000 <= d < 7000 for d in kept) and sum(d >= 7000 for d in kept) == 100


def test_levels_by_brute_force(spark):
    """The level of each stratum against the definition: the least one up to which every test passes, by exact tails."""
    from math import comb

    rng = random.Random(4)
    rows = [(k, "en" if k % 4 else None, min(24, int(rng.expovariate(1.5 if k % 5 else 0.15))), int(k % 5 > 0)) for k in range(9000)]
    q = quality_rules.QUALITY
    m = spark.createDataFrame(rows, "doc_id long, lang string, severity int, quality int")
    measures = m.select("doc_id", "lang", F.struct("severity", F.lit(False).alias("base_failed")).alias(q))
    got = {r.stratum: r.level for r in quality_rules.certified(measures, m.select("doc_id", "quality")).collect()}
    want = {}
    for s in ("en", None):
        mine = [(v, g) for _, lang, v, g in rows if lang == s]
        n, best = sum(g for _, g in mine), None
        for level in range(24, 0, -1):
            k, bad = sum(g for v, g in mine if v >= level), sum(1 - g for v, g in mine if v >= level)
            if sum(comb(n, j) * 0.01**j * 0.99 ** (n - j) for j in range(k + 1)) > 0.05 / 2:
                break
            if bad and (best is None or bad > best[0]):
                best = (bad, level)
        want[s] = best and best[1]
    assert got == want and all(want.values())


def test_simhash(docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    want = [(r[0], brute.fingerprint(r[1])) for r in rows()]
    of = dict(zip([(d, f) for d, f in want], brute.components(want)))
    for r in got:
        assert r.component_id == of[r.doc_id, r.fp % (1 << 64)]
    kept = simhash.one_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({c for c in of.values() if c is not None})
    assert simhash.near_duplicates(none).count() == simhash.one_each(none).count() == 0


def test_simhash_cells(spark, monkeypatch):
    """A chain and a dense cluster, with cells so small that they are cut into chunks; against a search over all pairs."""
    monkeypatch.setattr(simhash, "CELL", 8)
    rng = random.Random(3)
    center = rng.getrandbits(64)
    fps = {center}
    for _ in range(150):
        x = center
        for b in rng.sample(range(64), rng.randint(0, 4)):
            x ^= 1 << b
        fps.add(x)
    x = rng.getrandbits(64)
    for _ in range(40):
        for b in rng.sample(range(64), 3):
            x ^= 1 << b
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 1 << 63}
    fps = sorted(fps)
    sign = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(sign(f),) for f in fps], "fp long")
    root = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    want = brute.components([(i, f) for i, f in enumerate(fps)])
    groups, expected = {}, {}
    for i, f in enumerate(fps):
        groups.setdefault(root.get(sign(f), sign(f)), set()).add(f)
        expected.setdefault(want[i], set()).add(f)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in expected.values()}


def test_manhattan_is_a_lower_bound(spark):
    rng = random.Random(8)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", simhash.segment_counts(F.col("a")).alias("x"), simhash.segment_counts(F.col("b")).alias("y")).collect():
        want = sum(abs((r.a >> 2 * s & 3).bit_count() - (r.b >> 2 * s & 3).bit_count()) for s in range(32))
        assert ((r.x ^ r.y) & (1 << 64) - 1).bit_count() == want <= (r.a ^ r.b).bit_count()


ITEMS = [(1, "one two"), (2, None), (3, "..."), (10, " ".join(f"w{k}" for k in range(14))), (None, "one two three"), (1, "one two"), (5, "é" * 30)]


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    more = docs.unionByName(spark.createDataFrame([(50, "W0 w1, w2 w3 w4 w5 w6 w7 w8 w9 (w10) w12 ONE-two three", "en", "s", 1, *CLASHES)], DOCS))
    items = [(x[0] if x[0] is not None else "", x[1]) for x in ITEMS]
    for limit in (decontamination.PATTERN_CHARS, 40):  # one automaton, and several in turn
        h = "found"
        out = decontamination.scanned(more, bench, limit, h)
        assert out.drop(h).columns == more.columns
        for r in out.select("text", F.col(f"{h}.n_words").alias("n"), decontamination.n_hit(F.col(f"{h}.ranges")).alias("hit"), F.col(f"{h}.items").alias("items"), F.col(f"{h}.ranges").alias("ranges")).collect():
            n, hit, n_items, sha, _ = brute.contamination(r.text, items)
            assert (r.n, r.hit, len(r["items"]), decontamination.sha256_of(r["items"])) == (n, hit, n_items, sha)
            if r.ranges and r.text.startswith("W0"):
                spans = {r.text[x.start : x.end] for x in r.ranges}
                assert spans == {"W0 w1, w2 w3 w4 w5 w6 w7 w8 w9", "w1, w2 w3 w4 w5 w6 w7 w8 w9 (w10", "ONE-two", "ONE-two three"}
            for x in r.ranges:
                found = [m.span() for m in re.finditer(decontamination.WORDS, r.text.translate(brute.SMALL))]
                assert (x.start, x.end) == (found[x.first][0], found[x.last][1])
    assert decontamination.clean(none, bench).count() == 0 and decontamination.clean(more, bench).columns == more.columns
    assert decontamination.clean(docs, bench.limit(0)).count() == docs.count()


def test_pii(docs, none):
    out = pii.found(docs, name="found")
    assert out.drop("found").columns == docs.columns == pii.redacted(docs).columns
    for r in out.collect():
        assert [(s.kind, s.start, s.end) for s in r.found if s.base] == brute.pii(r.text)
    assert pii.redacted(none).count() == 0
    assert pii.redacted(docs).where("doc_id = 12").first().text == "[EMAIL] " * 40


@pytest.mark.parametrize(
    ("text", "span", "kind"),
    [
        ("write to jane.doe (at) example [dot] com today", "jane.doe (at) example [dot] com", "email"),
        ("write to jane at example dot co dot uk, ok", "jane at example dot co dot uk", "email"),
        ("mail jane＠example．com now", "jane＠example．com", "email"),
        ("mail jаne@exаmple.com now", "jаne@exаmple.com", "email"),
        ("call five five five one two three four five six seven now", "five five five one two three four five six seven", "phone"),
        ("card ４１１１ １１１１ １１１１ １１１１ ok", "４１１１ １１１１ １１１１ １１１１", "card"),
        ("card four one one one one one one one one one one one one one one one ok", "four one one one one one one one one one one one one one one one", "card"),
        ("host one nine two dot one six eight dot zero dot one up", "one nine two dot one six eight dot zero dot one", "ip"),
        ("host 192 dot 168 dot 0 dot 12 up", "192 dot 168 dot 0 dot 12", "ip"),
        ("Write jane dot doe AT example DOT com!", "jane dot doe AT example DOT com", "email"),
        ("host 10​.20​.30​.40 up", "10​.20​.30​.40", "ip"),
        ("call plus one oh one 5 5 5 1 2 3 4 now", "plus one oh one 5 5 5 1 2 3 4", "phone"),
        ("mail jane at example.com now", "jane at example.com", "email"),
        ("so jane.doe at example.com wrote", "jane.doe at example.com", "email"),
        ("to a dot b dot c dot d at mail dot x dot y dot com ok", "a dot b dot c dot d at mail dot x dot y dot com", "email"),
        ("to " + "n" * 90 + " at " + "h" * 90 + " dot com ok", "n" * 90 + " at " + "h" * 90 + " dot com", "email"),
    ],
)
def test_disguises(text, span, kind):
    found = [(k, text[a:b]) for k, a, b, base in pii.spans_of(text) if not base]
    assert (kind, span) in found
    assert span not in pii.masked(text, pii.spans_of(text))


def test_clean_prose_has_no_pii():
    for text in ("we met at noon. dot your eyes at the end", "one two three go", "a (dot) plot at 5 (at) home", "Привет, как дела? Это просто текст.", "see 1.2.3 and 12 34 56", "look at example.com now", "one of one oh one", "be at the bar.then go"):
        assert not pii.spans_of(text)


def test_pii_takes_linear_time():
    for text in ("a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "@" * 1_000_000, "a@" * 300_000, "+1 " * 300_000, "1 " * 500_000, "a dot " * 200_000, "a at " * 200_000, "a at b dot " * 100_000, "one " * 200_000):
        pii.spans_of(text)


def test_secrets(docs, none):
    out = secrets.found(docs, "found")
    assert out.drop("found").columns == docs.columns
    for r in out.collect():
        assert [(s.kind, s.start, s.end) for s in r.found if s.kind != "entropy"] == brute.secrets(r.text)
    assert secrets.found(none, "found").count() == 0


def test_entropy(spark):
    key = "q7Zp2Lx9Vb4Nc8Kd1Wm6Ts3Rf5Hg0Jy"
    cases = [
        (f"é key {key} end", [(6, 6 + len(key))]),
        ("id 123e4567-e89b-12d3-a456-426614174000 end", []),
        ("path /usr/local/share/python3/site end", []),
        ("aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", []),
        ("A9F3C07E5B2D8146A0F9C3E7B5D28164", [(0, 32)]),
        (f"token = {key}", []),  # a plain match already
        ("your-api-key-0123456789abcdefXYZ", []),
    ]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id long, text string")
    for r in secrets.found(df).collect():
        assert [(s.start, s.end) for s in r[secrets.SPANS] if s.kind == "entropy"] == cases[r.doc_id][1], r


def test_mixing(docs, none):
    got = mixing.mixed(docs).collect()
    assert len(got) == docs.count()
    assert sorted(r.size for r in got) == sorted(len(brute.WORD.findall(r[1] or "")) for r in rows())
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, *(c + "_" for c in mixing.NEW)]
    taken = out.collect()
    assert sum(r.taken_ for r in taken) == sum(r.taken for r in got) and all(r.size == "size" for r in taken)
    assert mixing.mixed(none).count() == mixing.mix(none).count() == 0


def test_mixing_repeated_rows(spark):
    """A third of all rows alike, others of the same id with another source: exact words for each source, reruns agree."""
    data = [(7, "a b c", "x")] * 400 + [(7, "a b c", "y")] * 100 + [(k, "w " * (k % 9 + 1), "xyz"[k % 3]) for k in range(100, 800)]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(data)], "doc_id long, text string, source string, other long").repartition(5)
    got = mixing.mixed(df).collect()
    assert len(got) == len(data) and sorted(got) == sorted(mixing.mixed(df).collect())
    by = {}
    for r in got:
        assert r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
        t = by.setdefault(r.source, [0, r.target])
        t[0] += r.taken
    assert all(abs(a - b) <= 9 for a, b in by.values())
    taken = mixing.mix(df).collect()
    assert len({r.other for r in taken}) == len(taken) and sum(r.taken for r in taken) == sum(r.taken for r in got)
    assert all((r.doc_id, r.text, r.source) == data[r.other] for r in taken)


def test_mixing_tree(spark, monkeypatch):
    """Many small buckets and a tree of several levels: each source stays within one small document of its target."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(2)
    data = [(k, "w " * rng.randint(1, 30), "hot" if k % 3 else f"s{k % 7}") for k in range(2000)]
    got = mixing.mixed(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    assert len(got) == 2000
    by = {}
    for r in got:
        t = by.setdefault(r.source, [0, r.target])
        t[0] += r.taken
        assert r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
    assert all(abs(a - b) <= 30 for a, b in by.values())


def test_classifier(docs, none, labels):
    got = quality_classifier.report(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality_classifier.report(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.report(none, labels).count() == 0


def test_lm(docs, none):
    got = lm_scoring.report(docs).collect()
    assert len(got) == docs.count()
    assert all(r.n_words == len(brute.WORD.findall(t or "")) for r, t in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words)), [x[1] for x in sorted(rows(), key=lambda x: (x[0] is None, x[0] or 0, len(x[1] or "")))]))
    assert lm_scoring.report(none).count() == 0


PAGES = [
    (1, "http://h.test/a", "<html><body><nav><a href=x>menu</a></nav><div class='post7'><h1>T&amp;t</h1><p>One  two\n three.<p>Four<br>five <b>six</b>.</div><aside>side</aside><div id=comments><p>first!</p></div><footer>f</footer></body></html>"),
    (2, "http://h.test/b", "<html><body><header>top</header><div class='post8'><p>Seven &lt;eight&gt; " + "word " * 60 + "</p><ul><li>a<li>b</ul><script>var x='<p>no</p>'</script><form><p>mail</p></form></div><div class='cookie-notice'>ok?</div></body></html>"),
    (3, None, None),
    (4, "", ""),
    (5, "nonsense", "just text & more <p>para"),
    (6, "http://H.test:80/c", "<div><p>" + "long " * 200_000 + "</p></div>"),
    (1, "http://h.test/a", "<p>again"),
    (None, "http://h.test/z", "<p>x<!-- c --></p>"),
]


def test_html(spark):
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, text string")
    got = html_text.extracted(df).collect()
    assert len(got) == len(PAGES)
    by = {}
    for r in got:
        assert r.n_chars == len(r.text)
        by.setdefault(r.page_id, []).append(r.text)
    assert "T&t\nOne two three.\nFour five six." in by[1] and "again" in by[1]
    assert by[2] == ["Seven <eight> " + " ".join(["word"] * 60) + "\na\nb"]
    assert by[3] == by[4] == [""]
    assert by[5] == ["just text & more\npara"]
    assert by[6] == [" ".join(["long"] * 200_000)]
    assert html_text.extracted(df.limit(0)).count() == 0


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 700)
    df = spark.createDataFrame([*PAGES[:5], *PAGES[6:], *[(k, f"http://h.test/{k}", f"<p>{k}</p>WARC/1.1\r\n\r\nWARC/1.1" * (k % 4)) for k in range(100, 400)]], "page_id long, url string, html string").repartition(3)
    got = warc.report(df).collect()
    assert len(got) == 307
    import zlib

    for r in got:
        assert r.intact == (r.page_id is None or zlib.crc32(str(r.page_id).encode()) % 97 != 0)
    assert warc.report(df.limit(0)).count() == 0


def test_warc_lost_records(spark):
    keys = "file long, ordinal long, offset long, length long, digest string"
    a = spark.createDataFrame([(f, o, 0, 1, f"{f}-{o}") for f in range(3) for o in range(40)], keys)
    b = a.where("not (file = 1 and ordinal > 20) and file <> 2")
    got = {(r.file, r.ordinal) for r in warc.compared(a, b).collect()}
    assert got == {(1, o) for o in range(21, 40)} | {(2, o) for o in range(40)}
