"""Edge cases of the operators, against plain Python."""

import math
import random

import pytest
from lectern.functions import signal as sig
from lectern.functions import text as txt
from lectern.operators import filters, mux, pending, plugins, segments, signal, subtitles, summary
from pyspark.sql import functions as F


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (0,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first().r


def stamp(s):
    ms = max(0, int(round(s * 1000)))
    return f"{ms // 3600000:02d}:{ms // 60000 % 60:02d}:{ms // 1000 % 60:02d},{ms % 1000:03d}"


def test_times(spark):
    rng = random.Random(1)
    values = [-1.0, 0.0, 0.0005, 0.0015, 0.0025, 1.0005, 59.9996, 3599.9999, 360000.0] + [rng.uniform(0, 4e5) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "s double").select("s", txt.srt_time(F.col("s")).alias("t")).collect()
    assert all(r.t == stamp(r.s) for r in rows)
    back = spark.createDataFrame([(stamp(v),) for v in values], "t string").select("t", txt.srt_milliseconds(F.col("t")).alias("ms")).collect()
    assert all(r.ms == max(0, round(v * 1000)) for r, v in zip(back, values))
    with pytest.raises(Exception, match="(?i)nan|cast"):
        one(spark, txt.srt_time(F.col("s")), s=("double", math.nan))


def test_white_space(spark):
    for s in ("a  b", " \t\n", "x", "　a\x1cb\u0085", ""):
        assert one(spark, txt.collapsed(F.col("s")), s=("string", s)) == " ".join(s.split())
        assert one(spark, txt.stripped(F.col("s")), s=("string", s)) == s.strip()


def test_subtitles(spark):
    rows = [(1, 0, "a"), (1, 1, "  "), (1, 2, "b  c"), (2, 0, "  "), (2, 1, "")]
    timed = subtitles.timed(spark.createDataFrame(rows, "k long, turn long, text string"), "k", "turn", "text")
    assert [r.number for r in subtitles.cues(timed, "k", "text").where("k = 1").orderBy("number").collect()] == [1, 3]
    docs = {r.k: (r.srt, r.n_cues) for r in subtitles.documents(subtitles.rendered(timed, "k", "text"), "k").collect()}
    assert docs[2] == ("\n", 0)
    assert docs[1] == (f"1\n{stamp(0)} --> {stamp(1 / 16)}\na\n\n3\n{stamp(3 / 16)} --> {stamp(7 / 16)}\nb c\n", 2)


def test_srt_parsing(spark):
    text = "﻿1\r\n00:00:00,000 --> 00:00:01,500\r\nfirst\r\nline two\r\n\r\n7\r\n100:00:00,000 --> 100:00:02,000\r\nlast\r\n"
    got = subtitles.parsed(spark.createDataFrame([(1, text)], "k long, srt string"), "k", "srt").orderBy("pos").collect()
    assert [(r.number, r.start_ms, r.end_ms, r.content) for r in got] == [(1, 0, 1500, "first\nline two"), (7, 360000000, 360002000, "last")]
    new = subtitles.recomposed(subtitles.translated(subtitles.parsed(spark.createDataFrame([(1, text)], "k long, srt string"), "k", "srt"), "content", F.upper), "k").orderBy("number").collect()
    assert [(r.number, r.content) for r in new] == [(1, "FIRST\nLINE TWO"), (2, "LAST")]


def test_translation_keeps_blank_text(spark):
    df = spark.createDataFrame([("  ",), ("a\r\nb",)], "t string")
    assert [r.t for r in subtitles.translated(df, "t").collect()] == ["  ", "a\nb"]


def test_distinct_texts_are_translated_once(spark):
    """Calls and loads are counted; blank and null texts stay."""
    seen, loads = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def model(texts):
            seen.add(len(texts))
            return texts.str.upper()

        return model

    rows = [(k, f" line {k % 7}\nend ", "x") for k in range(500)] + [(500, "  ", "x"), (501, None, "x")]
    df = spark.createDataFrame(rows, "k long, t string, __other string").repartition(8)
    got = {r.k: r.t for r in subtitles.translated_once(df, "t", load).collect()}
    assert got == {k: f"LINE {k % 7}\nEND" for k in range(500)} | {500: "  ", 501: None}
    assert seen.value == 7 and 1 <= loads.value <= 8


def test_languages(spark):
    rows = [('{"result": {"language": "en"}}',), ('{"result":{"language":"es"}}',), ('{"result":{"language":"fr"}}',), ("{}",), ("not json",), (None,)]
    got = spark.createDataFrame(rows, "j string").select(subtitles.detected_language(F.col("j")).alias("l")).select("l", *subtitles.routes(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [("en", "copy_source", "translate_source"), ("es", "asr_translate", "copy_source"), ("fr", "asr_translate", "translate_english")] + [("unknown", "asr_translate", "translate_english")] * 3


@pytest.mark.parametrize(("d", "chunk"), [(900.4, 900), (600.0, 300), (601.0, 300), (0.0, 300), (0.5, 300), (299.999, 300)])
def test_segments(spark, d, chunk):
    df = spark.createDataFrame([(1, d)], "k long, d double")
    cut = segments.truncated(df, "d", chunk).orderBy("idx").collect()
    want, start = [], 0.0
    while start < d:
        want.append((start, min(chunk, d - start)))
        start += chunk
    assert [(r.start, r.length) for r in cut] == want
    assert one(spark, segments.floored_count(F.col("d"), chunk), d=("double", d)) == (int(d) + chunk - 1) // chunk


def test_overlap(spark):
    got = segments.overlapping(spark.createDataFrame([(1, 601.0)], "k long, d double"), "d", 300, 2).orderBy("idx").collect()
    assert [(r.start, r.length, r.has_overlap_start) for r in got] == [(0, 300, False), (298, 302, True), (598, 3, True)]


def test_ranked_and_batches(spark):
    ids = random.Random(4).sample(range(10**6), 1000)
    df = spark.createDataFrame([(i,) for i in ids], "i long").repartition(7)
    got = segments.mini_batches(df, "i", 0).collect()
    assert [(r.i, r.place, r.batch_id) for r in sorted(got)] == [(v, k, k // 200) for k, v in enumerate(sorted(ids))]


def test_ties_have_the_same_places_however_the_input_is_split(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).alias("k"))
    one, other = ({r.id: r.place for r in segments.ranked(df.repartition(n), "k", "place", 700).collect()} for n in (1, 7))
    assert one == other and sorted(one.values()) == list(range(3000))


def test_ranks_with_a_payload(spark):
    """Three million rows, a third of them with one value: each place once, in order."""
    n = 3_000_000
    df = spark.range(0, n, 1, 16).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.xxhash64("id")).alias("o"), F.concat(F.lit("payload "), F.col("id")).alias("p"))
    out = segments.ranked(df, "o", "place", 200_000).cache()
    assert tuple(out.agg(F.count("*"), F.countDistinct("place"), F.min("place"), F.max("place"), F.countDistinct("p")).first()) == (n, n, 0, n - 1, n)
    pairs = out.select("place", "o", F.floor(F.col("place") / 1000).alias("run"))
    bounds = [tuple(r) for r in pairs.groupBy("run").agg(F.min("o").alias("a"), F.max("o").alias("b")).orderBy("run").select("a", "b").collect()]
    assert all(x[1] <= y[0] for x, y in zip(bounds, bounds[1:]))
    out.unpersist()
    assert segments.ranked(df.limit(0), "o", "place").count() == 0


def test_split_policy_and_done_table(spark, tmp_path):
    df = spark.createDataFrame([(1, True, 2), (1, False, 2), (2, True, 1), (3, False, 1)], "k long, there boolean, n long")
    got = {r.k: (r.n_present, r.skip_split, r.complete, r.partial) for r in pending.split_policy(df, "k", F.col("there"), F.max("n")).collect()}
    assert got == {1: (1, True, False, True), 2: (1, True, True, False), 3: (0, False, False, False)}
    sizes = spark.createDataFrame([(1, 1000), (2, 1001), (2, 5000), (3, None)], "k long, size long")
    for _ in range(2):
        pending.mark_done(sizes, "k", "size", str(tmp_path / "done"))
    assert [r.k for r in pending.marked_done(spark, str(tmp_path / "done"), "k long").collect()] == [2]


def test_summary_document(spark):
    import json

    df = spark.createDataFrame([(1, 2, 'é "x"\n', None), (1, 1, "a", 1.5), (2, 1, "", 2.0)], "b long, o long, t string, v double")
    got = {r.b: r for r in summary.summary_document(df, "b", "o", ["o", "t", "v"]).collect()}
    want = [{"o": 1, "t": "a", "v": 1.5}, {"o": 2, "t": 'é "x"\n', "v": None}]
    assert got[1].json == json.dumps(want, indent=2, ensure_ascii=False) and got[1].n_items == 2


def test_texts_and_ratios(spark):
    value = lambda f, x, t: one(spark, f(F.col("x")), x=(t, x))
    assert [value(txt.minutes_text, s, "double") for s in (0.0, 59.0, 3600.4)] == ["0.0 min", "1.0 min", "60.0 min"]
    assert value(txt.gigabytes_text, 3 << 29, "long") == "1.5 GB"
    assert [value(txt.ratio, t, "string") for t in ("25/1", "30000/1001", "0/0", "x", "24", None)] == [25.0, 30000 / 1001, None, None, 24.0, None]
    assert value(sig.checked_method, "kaiser_best", "string") == "linear"
    with pytest.raises(Exception, match="method must be one of"):
        value(sig.checked_method, "cubic", "string")


def test_skip_policies(spark):
    sizes = [None, 0, 1, 1000, 1001, 1024, 1025, 10000, 10001]
    df = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", *pending.policies(F.col("s")))
    for r in df.collect():
        assert [r.exists, r.non_empty, r.over_1000, r.over_10000, r.over_1k_block] == [r.s is not None, *[r.s is not None and r.s > t for t in (0, 1000, 10000, 1024)]]
    work, out = spark.range(5).withColumnRenamed("id", "k"), spark.createDataFrame([(1, 0), (2, 5000)], "k long, size long")
    assert {r.k for r in pending.pending(work, out, "k", "size", 1000).collect()} == {0, 1, 3, 4}


def test_forced_asr_does_not_transcribe(spark):
    no, yes = F.lit(False), F.lit(True)
    r = spark.range(1).select(*pending.decisions(no, yes, no, yes, yes, yes, yes, yes)).first()
    assert (r.make_audio, r.make_asr_audio, r.transcribe, r.remux) == (False, True, False, False)


def test_filters(spark):
    chain = lambda profile, base, dual=False, override=None: one(spark, filters.pre_clean(F.col("p"), F.col("b"), F.lit(dual), F.col("o")), p=("string", profile), b=("int", base), o=("string", override))
    hum = chain("hum", 60)
    assert [f"bandreject=f={60 * h}:w={7 + h}" for h in range(1, 11)] == hum.split(",")[2:-1]
    assert len(chain("electronic", 100).split(",")) == 3 + 9
    assert "f=50:w=8" in chain("hum", 60, True) and "f=60:w=8" in chain("hum", 50, True)
    assert chain("none", 60) == "anull" and chain("bad", 60, override="x=1") == "x=1"
    with pytest.raises(Exception, match="unknown profile"):
        chain("bad", 60)


def test_paths(spark):
    path = lambda p: one(spark, txt.container_path(F.col("p"), "/srv"), p=("string", p))
    assert [path("/srv"), path("/srv/a/b.mp4"), path("/other/x")] == ["/workspace", "/workspace/a/b.mp4", "/workspace//other/x"]
    assert one(spark, txt.stem(F.col("p")), p=("string", "/a/b.c.mp4?x=1")) == "b.c"
    assert one(spark, txt.padded(F.col("i"), "c_", ""), i=("int", 10000)) == "c_10000"
    assert one(spark, txt.setting(F.col("v"), "d"), v=("string", "")) == "d"
    assert [one(spark, txt.flag(F.col("v")), v=("string", v)) for v in ("1", "0", "yes", None)] == [True, False, False, False]


def resample(x, old, new):
    if old == new:
        return x
    n = len(x)
    m = max(1, round(n * new / old))
    out = []
    for i in range(m):
        p = max((i + 0.5) * (n / m) - 0.5, 0.0)
        lo = min(int(p), n - 1)
        out.append(x[lo] * (1 - (p - lo)) + x[min(lo + 1, n - 1)] * (p - lo))
    return out


@pytest.mark.parametrize(("n", "old", "new"), [(8, 48000, 16000), (5, 16000, 48000), (1, 48000, 16000), (3, 2, 2), (64, 48000, 44100)])
def test_resample(spark, n, old, new):
    x = [math.sin(k) for k in range(n)]
    got = signal.resampled(signal.whole(spark.createDataFrame([(1, x)], "k long, x array<double>"), ["k"], "x"), ["k"], old, [new]).orderBy("pos").collect()
    assert [r.v for r in got] == resample(x, old, new) and [r.pos for r in got] == list(range(len(got)))
    cut = spark.createDataFrame([(1, k, x[k : k + 3]) for k in range(0, n, 3)], "k long, start long, samples array<double>").repartition(3)
    got = signal.resampled(signal.haloed(cut, ["k"]), ["k"], old, [new]).orderBy("pos").collect()
    assert [r.v for r in got] == resample(x, old, new) and [r.pos for r in got] == list(range(len(got)))


def test_a_long_signal(spark):
    """Ten million samples in chunks of 65,536: a straight line stays one, whatever the rate."""
    n, size = 10_000_000, 1 << 16
    ids = spark.range(-(-n // size)).select(F.lit(1).alias("k"), (F.col("id") * size).alias("start"))
    chunks = ids.select("k", "start", F.transform(F.sequence(F.col("start"), F.least(F.col("start") + size, F.lit(n)) - 1), lambda i: i.cast("double")).alias("samples"))
    out = signal.resampled(signal.haloed(chunks, ["k"]), ["k"], 48000, [16000])
    m = round(n / 3)
    r = out.agg(F.count("*"), F.countDistinct("pos"), F.max("pos"), F.max(F.abs(F.col("v") - ((F.col("pos") + 0.5) * (n / m) - 0.5)))).first()
    assert tuple(r)[:3] == (m, m, m - 1) and r[3] < 1e-6
    loud = signal.levels(chunks, ["k"]).first()
    assert loud.peak == n - 1 and loud.rms == pytest.approx(math.sqrt(sum(x * x for x in range(n)) / n))


def test_normalised(spark):
    df = spark.createDataFrame([(1, 0, [0.1, -0.2]), (1, 2, [0.4]), (2, 0, [0.0, 0.0])], "k long, start long, samples array<double>")
    got = {(r.k, r.start): r.samples for r in signal.normalised(df, ["k"], 0.5).collect()}
    assert got == {(1, 0): [0.1 * 1.25, -0.2 * 1.25], (1, 2): [0.5], (2, 0): [0.0, 0.0]}


def test_shapes(spark):
    shape = lambda rows: (lambda r: (len(r), len(r[0])))(one(spark, sig.samples_first(F.col("x")), x=("array<array<double>>", rows)))
    assert shape([[0.0] * 32] * 2) == (32, 2) and shape([[0.0] * 2] * 32) == (32, 2) and shape([[0.0]] * 2) == (2, 1)
    clamp = [one(spark, sig.clamp(F.col("x")), x=("double", v)) for v in (-2.0, 0.5, 2.0, math.nan)]
    assert clamp[:3] == [-1.0, 0.5, 1.0] and math.isnan(clamp[3])
    assert one(spark, sig.downmix(F.col("a"), F.col("b")), a=("array<double>", [1.0, 2.0]), b=("array<double>", [3.0, 0.0])) == [2.0, 1.0]


def left_fold(chunks, overlap):
    out = []
    for c in chunks:
        n = min(overlap, len(c), len(out))
        w = [k / (n - 1) if n > 1 else 0.0 for k in range(n)]
        out = out[: len(out) - n] + [a * (1 - v) + b * v for a, b, v in zip(out[len(out) - n :], c, w)] + c[n:]
    return out


def test_crossfade(spark):
    rng = random.Random(6)
    sets = [[20] * 4, [30, 35, 35, 15], [7, 3, 2, 9, 1, 1, 4, 12], [2, 1, 3, 2, 8], [1], [4, 4, 4, 4, 4], [5, 0, 6]]
    sets += [[rng.randint(1, 14) for _ in range(rng.randint(1, 9))] for _ in range(40)]
    talks = [[[rng.uniform(-1, 1) for _ in range(n)] for n in sizes] for sizes in sets]
    df = spark.createDataFrame([(t, k, c) for t, chunks in enumerate(talks) for k, c in enumerate(chunks)], "talk long, idx int, x array<double>").repartition(5)
    for overlap in (5, 1, 0):
        got = {}
        for r in signal.crossfaded(df, "talk", "idx", "x", overlap).collect():
            got.setdefault(r.talk, {})[r.pos] = r.v
        for t, chunks in enumerate(talks):
            want = left_fold(chunks, overlap)
            assert sorted(got[t]) == list(range(len(want))) and [got[t][k] for k in range(len(want))] == pytest.approx(want, abs=1e-12)


def test_crossfade_of_overlapping_segments(spark):
    df = spark.createDataFrame([(1, 100.0, [float(k) for k in range(100)])], "talk long, d double, x array<double>")
    cut = segments.overlapping(df, "d", 30, 5)
    chunks = cut.select("talk", "idx", F.slice("x", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("x"))
    got = [r.v for r in signal.crossfaded(chunks, "talk", "idx", "x", 5).orderBy("pos").collect()]
    assert got == pytest.approx([float(k) for k in range(100)])


def test_mux_and_manifest(spark):
    df = spark.createDataFrame([(1, k) for k in (10000, 9999, 1001)], "talk long, idx long")
    assert mux.manifest(df, "talk", "idx", txt.padded(F.col("idx"), "c_", "")).first().manifest == "file 'c_1001'\nfile 'c_9999'\nfile 'c_10000'"
    a, b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k long, a double"), spark.createDataFrame([(1, 5.0)], "k long, b double")
    assert [tuple(r) for r in mux.muxed([a, b], "k", ["a", "b"]).collect()] == [(1, 2.0, 5.0, 2.0)]
    assert mux.muxed([a, b], "k", ["a", "b"], shortest=False).first().duration_s == 5.0
    four = spark.createDataFrame([(1, 4.0, 3.0, 2.0, 1.0, 1.0)], "k long, v double, a double, s double, e double, duration_s double")
    assert [(r.stream, r.kind, r.language, r.title, r.source_s) for r in mux.streams(four, "k", ["v", "a", "s", "e"]).orderBy("stream").collect()] == [
        (0, "video", None, None, 4.0), (1, "audio", None, None, 3.0), (2, "subtitle", "spa", "Español", 2.0), (3, "subtitle", "eng", "English", 1.0)
    ]


def test_failures_are_rows(spark):
    def load():
        def model(batch):
            if (batch["k"] == 1).any():
                raise ValueError("bad item")
            return batch

        return model

    got = plugins.transformed(spark.range(3).withColumnRenamed("id", "k").coalesce(1), load, "k long, status string, error string")
    assert [tuple(r) for r in got.orderBy("k").collect()] == [(0, "ok", ""), (1, "error", "bad item"), (2, "ok", "")]
    many = plugins.transformed(spark.range(1000).withColumnRenamed("id", "k").coalesce(1), load, "k long, status string, error string")
    assert [r.k for r in many.where("status = 'error'").collect()] == [1] and many.count() == 1000

    def load_telling():
        return lambda batch: batch.assign(error=batch["k"].map(lambda k: "odd" if k % 2 else None))

    told = plugins.transformed(spark.range(4).withColumnRenamed("id", "k"), load_telling, "k long, status string, error string").orderBy("k").collect()
    assert [tuple(r) for r in told] == [(0, "ok", ""), (1, "error", "odd"), (2, "ok", ""), (3, "error", "odd")]
    s = summary.batch_summary(got.withColumn("batch", F.lit(1)), "batch", F.col("status") != "ok").first()
    assert (s.n_items, s.n_failed, s.n_ok, s.exit_status) == (3, 1, 2, 1)
