import math
import random
import re
import string
import time
from collections import Counter

import pytest
from lectern.llm import secrets
from pyspark.sql import functions as F

from . import brute

KIND = "doc_id long, text string"


def entropy_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), KIND)
    return {r.doc_id: [(s.start, s.end) for s in r[secrets.SPANS] if s.kind == "entropy"] for r in secrets.found(df).collect()}


@pytest.mark.parametrize(
    "alphabet",
    [string.ascii_uppercase + "234567", string.ascii_lowercase + "234567", string.ascii_lowercase + string.digits, string.ascii_letters + string.digits],
)
def test_random_keys_of_each_alphabet_are_found(spark, alphabet):
    rng = random.Random(4)
    keys = []
    while len(keys) < 300:
        key = "".join(rng.choice(alphabet) for _ in range(20 + 4 * (len(keys) % 4)))
        if any(c.isdigit() for c in key):
            keys.append(key)
    got = entropy_spans(spark, [f"key {k} end" for k in keys])
    assert sum(bool(x) for x in got.values()) >= 0.97 * len(keys)


def test_keys_glued_to_plain_matches_are_found(spark):
    key, akia, digest = "q7Zp2Lx9Vb4Nc8Kd1Wm6Ts3Rf5Hg0Jy", "AKIA" + "Q2W3E4R5T6Y7U8I9", "0f1e2d3c4b5a69788796a5b4"
    texts = [f"{akia}/{key} end", f"é {key}+{akia}", f"{digest}_{key}", f"{akia}={key}-{akia}", f"{akia}/short1"]
    want = [[(21, 52)], [(2, 33)], [(25, 56)], [(21, 52)], []]
    assert entropy_spans(spark, texts) == dict(enumerate(want))


def test_entropy_windows_by_brute_force(spark):
    """Each window's entropy from its own characters, over strings that are random in parts."""
    rng = random.Random(9)
    alphabets = [string.hexdigits.lower()[:16], string.ascii_uppercase + "234567", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"]
    texts = []
    for k in range(400):
        a = alphabets[k % 4]
        parts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 40))), rng.choice("ab1") * rng.randint(0, 15), "".join(rng.choice(a[:8]) for _ in range(rng.randint(5, 30)))]
        rng.shuffle(parts)
        texts.append("é " * rng.randint(0, 2) + "".join(parts) + " end")

    def bits(s):
        core = s.strip(secrets.GLUE)
        if re.fullmatch("[0-9A-Fa-f]+", s):
            return secrets.HEX_BITS
        if re.fullmatch("[0-9A-Z]+|[0-9a-z]+", core):
            return secrets.ONE_CASE_BITS
        return secrets.BOTH_CASES_BITS if re.fullmatch("[0-9A-Za-z]+", core) else secrets.BASE64_BITS

    def entropy(window):
        return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())

    want = {}
    for i, text in enumerate(texts):
        want[i] = []
        for m in re.finditer(secrets.CANDIDATE, text):
            if any(re.search(p, m.group()) for p in secrets.ALLOWED):
                continue
            n = secrets.WINDOW
            high = [k for k in range(len(m.group()) - n + 1) if entropy(m.group()[k : k + n]) >= bits(m.group())]
            if high:
                want[i].append((m.start() + high[0], m.start() + high[-1] + n))
    plain = {i for i, t in enumerate(texts) if brute.secrets(t)}
    got = entropy_spans(spark, texts)
    assert {i: x for i, x in got.items() if i not in plain} == {i: x for i, x in want.items() if i not in plain}
    assert len(plain) < 150 and sum(map(bool, want.values())) > 100


def test_long_texts_take_no_stack_and_little_time(spark):
    """Texts of half a megabyte of each kind, with the JVM's own stack."""
    rng, size = random.Random(9), 1 << 19
    whole = lambda unit: unit * (size // len(unit))
    digits = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [
        whole("/docs/b1") + " 12345/",
        whole("/docs/b1") + "/x",
        whole("-"),
        whole("some-slug-of-words_"),
        whole("a-----b1"),
        "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(size)),
        whole("token=abcdefgh "),
        whole("token=abcdefgh"),
        "-".join(digits(24) for _ in range(size // 25)),
        " ".join(digits(24) for _ in range(size // 25)),
        whole("AKIA" + "Q2W3E4R5T6Y7U8I9" + "/"),
        whole("é"),
    ]
    start = time.time()
    got = {r.doc_id: r for r in secrets.report(spark.createDataFrame(list(enumerate(texts)), KIND).repartition(8)).collect()}
    assert time.time() - start < 150
    assert got[6].n_assign == size // 15 and got[8].n_hex == got[9].n_hex == size // 25 and got[10].n_access == size // 21
    assert got[5].spans.startswith("entropy:0:") and not got[0].spans and not got[3].spans


def test_running(spark):
    sizes = [0, 1, 2, 3, 7, 64, 65, 1000]
    df = spark.createDataFrame([([k % 5 for k in range(n)],) for n in sizes], "x array<bigint>")
    for (x,), (got,) in zip(df.collect(), df.select(secrets.running(F.col("x"), lambda a, b: a + b)).collect()):
        assert got == [sum(x[: k + 1]) for k in range(len(x))]
    cut = spark.createDataFrame([([1, 3, 3, 8], [0, 3, 4, 9]), ([], [5]), ([5], [])], "p array<bigint>, a array<bigint>")
    assert [(list(r[0]), list(r[1])) for r in cut.select(secrets.ranks(F.col("p"), F.col("a"), True), secrets.ranks(F.col("p"), F.col("a"), False)).collect()] == [([0, 3, 3, 4], [0, 1, 3, 4]), ([0], [0]), ([], [])]
