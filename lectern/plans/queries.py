"""The queries of the library, each over whole tables, with the DuckDB SQL that gives the same rows.

The fixtures hold no media. A document stands for a talk of n_chars / 16 seconds, a conversation for its transcript, an
embedding for a short signal, a page's url for a path, a label for an output that exists.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import signal as sig
from lectern.functions import text as txt
from lectern.operators import chains, dynamics, filters, loudness, mux, pending, plugins, recurrent, resampling, segments, signal, spectral, speech, subtitles, summary
from lectern.sources import files, media
from lectern.sources.files import table
from lectern.sources.shared import new_path

ROOT = "/srv/talks"
Query = Callable[[SparkSession, str], DataFrame]


def talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", (F.col("n_chars") / 16.0).alias("duration_s"))


def q01_discover_talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").where(F.col("url").contains(".example.com/"))
    s = txt.stem(F.col("url"))
    return pages.select("page_id", s.alias("stem"), F.concat(s, F.lit("_enhanced.wav")).alias("audio"), F.concat(s, F.lit("_es.srt")).alias("srt_es"), F.concat(s, F.lit("_en.srt")).alias("srt_en"), F.concat(s, F.lit("_final.mkv")).alias("video"), txt.padded(F.col("page_id"), "chunk_", ".wav").alias("chunk_name"))


def q02_probe_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.floor("duration_s").cast("bigint")
    return talks(spark, sf_dir).select("doc_id", "duration_s", whole.alias("whole_s"), F.floor(whole / 3600).cast("bigint").alias("hours"), F.floor(whole % 3600 / 60).cast("bigint").alias("minutes"))


def q03_segment_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("ts")
    rows = events.select("ts", F.explode(F.array(F.lit(300), F.lit(900))).alias("chunk_s"))
    at, offset = segments.micros("ts"), segments.offset_in("ts", F.col("chunk_s"))
    cut = rows.select("chunk_s", offset.alias("offset_us"), (at - offset).alias("chunk_start_us"))
    return cut.groupBy("chunk_s", "chunk_start_us").agg(F.count(F.lit(1)).alias("n"), F.min("offset_us").alias("first_offset_us"), F.max("offset_us").alias("last_offset_us"))


def q04_chunk_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("is_done")).distinct()
    chunks = talks(spark, sf_dir).withColumn("expected", segments.floored_count(F.col("duration_s"), 900))
    rows = chunks.join(done, "doc_id", "left").withColumn("is_done", F.coalesce("is_done", F.lit(False)))
    return pending.progress(rows, "lang", "expected", "is_done")


def q05_skip_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return talks(spark, sf_dir).select("doc_id", "n_chars", *pending.policies(F.col("n_chars")))


def q06_pending_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = pending.pending(talks(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id")
    return left.select("doc_id", "lang", F.ceil(F.col("duration_s") / 900).cast("bigint").alias("n_chunks"))


def q07_ordered_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = mux.concatenated_of("turn", "text")
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(mux.manifest_of("turn", txt.padded(F.col("turn"), "chunk_", ".wav")).alias("manifest"), F.count(F.lit(1)).alias("n_chunks"), whole.alias("whole"))
    return lists.select("conv_id", "manifest", "n_chunks", F.md5(F.col("whole").cast("binary")).alias("whole_md5"), F.length("whole").cast("bigint").alias("whole_chars"))


def q08_mux_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both tracks come from one aggregate: an inner join of two would shuffle the turns twice.
    first = lambda role: mux.first_of(F.length("text") / 16.0, "turn", F.col("role") == role)
    both = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(first("user").alias("user_s"), first("assistant").alias("assistant_s"))
    both = both.where("user_s is not null and assistant_s is not null")
    return both.withColumn("duration_s", F.least("user_s", "assistant_s")).withColumn("longest_s", F.greatest("user_s", "assistant_s"))


def q09_mux_four(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    # One aggregate makes all four tracks; a track without a turn is null, and a talk needs all of them.
    total = lambda when: F.sum(F.when(when, F.length("text"))) / 16.0
    tracks = turns.groupBy("conv_id").agg(
        ((F.max("turn") - F.min("turn") + 1) * 30.0).alias("video_s"),
        total(F.lit(True)).alias("audio_s"),
        total(F.col("role") == "user").alias("es_s"),
        total(F.col("role") == "assistant").alias("en_s"),
    )
    return tracks.where("es_s is not null and en_s is not null").withColumn("duration_s", F.least("video_s", "audio_s", "es_s", "en_s"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return subtitles.timed(turns, "conv_id", "turn", "text")


def q10_srt_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtitles.documents(subtitles.rendered(_segments(spark, sf_dir), "conv_id", "text"), "conv_id")


def q11_srt_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtitles.cues(_segments(spark, sf_dir), "conv_id", "text")


def q12_srt_translate_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = subtitles.parsed(q10_srt_document(spark, sf_dir), "conv_id", "srt")
    return subtitles.documents(subtitles.recomposed(subtitles.translated(read, "content"), "conv_id"), "conv_id")


def q13_language_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("lang").alias("language"))
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.regexp_extract("html", '<html lang="([^"]+)"', 1).alias("language"))
    result = docs.unionByName(pages).select("kind", "id", F.to_json(F.struct(F.struct("language").alias("result"))).alias("json"))
    found = result.select("kind", "id", subtitles.detected_language(F.col("json")).alias("language"))
    return found.select("*", *subtitles.routes(F.col("language")))


def q14_package_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("en", "es", "en_es_1", 1), ("en", "es", "en_es_2", 2), ("fr", "en", "fr_en_1", 3), ("de", "en", "de_en_1", 4)]
    packages = spark.createDataFrame(rows, "lang string, to_code string, package string, rank int")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.col("lang") == "en", "es").otherwise("en").alias("to_code"))
    return subtitles.first_match(docs, packages, ["lang", "to_code"], "rank").select("doc_id", "lang", "to_code", "package", F.col("package").isNull().alias("fatal"))


def q15_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.batch_summary(table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "error")


def q15b_batch_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"), F.col("user_id").alias("batch"))
    return rows.select("event_id", summary.result_json(["event_id", "status", "batch"]).alias("json"))


def q16_regen_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("flags"))
    bit = lambda k: txt.flag((F.shiftright("flags", k) % 2).cast("string"))
    have = F.col("quality") == 1
    return masks.select("doc_id", "flags", *pending.decisions(bit(0), bit(1), bit(2), have, F.col("toxic") == 0, have, have, F.lit(False)))


def q17_filter_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    profile = F.when(kind == "view", "none").when(kind == "signup", "gentle").when(kind == "error", "electronic").otherwise("hum")
    override = F.when(F.col("event_id") % 50 == 0, "highpass=f=100").otherwise("")
    base = F.when(F.col("user_id") % 2 == 0, 60).otherwise(50)
    return e.select("event_id", profile.alias("profile"), base.alias("base"), filters.pre_clean(profile, base, F.col("event_id") % 3 == 0, override).alias("chain"))


def q18_container_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    below = F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1)
    path = F.when(F.col("page_id") % 10 == 0, F.lit(ROOT)).otherwise(F.concat(F.lit(ROOT + "/"), below))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), txt.container_path(path, ROOT).alias("container"))


def _waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", sig.doubles(F.col("embedding")).alias("x"))


def q19_clamp_and_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud = _waves(spark, sf_dir).select("vec_id", F.transform("x", lambda v: sig.clamp(v * 4)).alias("x"))
    shaped = loud.select("vec_id", sig.samples_first(sig.channels(F.col("x"), 2, 32)).alias("rows"))
    rows = shaped.select("vec_id", F.posexplode("rows").alias("pos", "frame"))
    return rows.select("vec_id", "pos", F.get("frame", F.lit(0)).alias("left"), F.get("frame", F.lit(1)).alias("right"), F.size("frame").alias("n_channels"), sig.pcm16(F.get("frame", F.lit(0))).cast("int").alias("left_pcm"))


def q20_downmix(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = _waves(spark, sf_dir).select("vec_id", F.slice("x", 1, 32).alias("left"), F.slice("x", 33, 32).alias("right"))
    mixed = two.select("vec_id", F.arrays_zip(sig.downmix(F.col("left"), F.col("right")).alias("mono"), F.col("left").alias("first")).alias("s"))
    rows = mixed.select("vec_id", F.posexplode("s").alias("pos", "s"))
    return rows.select("vec_id", "pos", F.col("s.mono").alias("mono"), F.col("s.first").alias("first"))


def q20b_audio_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _waves(spark, sf_dir).select("vec_id", sig.audio_metadata(sig.channels(F.col("x"), 2, 32), 48000).alias("m"))
    return meta.select("vec_id", "m.sample_rate", "m.num_frames", "m.num_channels", "m.bits_per_sample", "m.encoding")


def q21_resample_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.resampled(signal.whole(_waves(spark, sf_dir), ["vec_id"], "x"), ["vec_id"], 48000, [16000, 96000])


def _stereo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, start, left, right): chunks of ten samples, so that signals lie over several."""
    two = _waves(spark, sf_dir).select("vec_id", "x", F.explode(F.sequence(F.lit(0), F.lit(31), F.lit(10))).alias("start"))
    return two.select("vec_id", "start", *[F.slice("x", F.col("start") + 1 + first, F.least(F.lit(10), 32 - F.col("start"))).alias(name) for name, first in (("left", 0), ("right", 32))])


def q21b_asr_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.asr_ready(_stereo(spark, sf_dir), ["vec_id"], "left", "right")


def q22_level_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signal.levels(signal.whole(_waves(spark, sf_dir), ["vec_id"], "x"), ["vec_id"])
    return found.select("vec_id", "rms", "peak", (0.5 / F.col("peak")).alias("peak_gain"), (0.1 / F.col("rms")).alias("rms_gain"))


def q22b_normalised_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.exploded(signal.normalised(signal.whole(_waves(spark, sf_dir), ["vec_id"], "x"), ["vec_id"], 0.5), ["vec_id"], "samples")


def q23_progress_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return summary.eta(rows, "user_id", ["ts", "event_id"], "value").select("event_id", "user_id", "done", "total", "elapsed_s", "mean_s", "eta_s")


RATE = 16


def _talk_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(talk, x, duration_s): four vectors after one another are a signal of RATE samples a second; a null one adds nothing."""
    four = table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull()).select(F.floor(F.col("vec_id") / 4).cast("bigint").alias("talk"), "vec_id", sig.doubles(F.col("embedding")).alias("x"))
    whole = four.groupBy("talk").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "x"))), lambda s: s["x"])).alias("x"))
    return whole.withColumn("duration_s", F.size("x") / float(RATE))


def _talk_chunks(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """(talk, start, samples): the signals as chunk rows of so many samples; the last is shorter."""
    return signal.chunked(_talk_signals(spark, sf_dir), ["talk"], "x", size)


def q24_crossfade_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = segments.overlapping(_talk_signals(spark, sf_dir), "duration_s", 5, 2)
    # Each chunk comes back from its own run of a model: here a little louder than the one before.
    part = F.slice("x", (F.col("start") * RATE + 1).cast("int"), (F.col("length") * RATE).cast("int"))
    chunks = cut.select("talk", "idx", F.transform(part, lambda v: v * (1.0 + F.col("idx") / 4.0)).alias("x"))
    return signal.crossfaded(chunks, "talk", "idx", "x", 2 * RATE)


def q25_segment_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.truncated(talks(spark, sf_dir), "duration_s", 300).select("doc_id", "idx", "start", "length")


def q26_segment_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.overlapping(talks(spark, sf_dir), "duration_s", 300, 2).select("doc_id", "idx", "start", "length", "has_overlap_start", txt.padded(F.col("idx"), "chunk_", ".wav").alias("name"))


def q27_slot_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return summary.dispatched(jobs, "o_orderdate", "o_orderkey", [3, 1]).select("o_orderkey", "place", "device", "state")


def q28_mini_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = pending.pending(talks(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang")
    return segments.mini_batches(left, "doc_id", 200).select("doc_id", "lang", "place", "batch_id")


def q29_prefix_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.prefix(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "ts", 300).select("event_id", "user_id")


def q30_external_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load():
        """Stands for a model: halves samples, and cannot do vectors of label 9."""

        def model(batch: pd.DataFrame) -> pd.DataFrame:
            bad = batch["label"] == 9
            return batch.assign(x=batch["x"].where(bad, batch["x"] / 2), error=bad.map({True: "label 9", False: ""}))

        return model

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", sig.doubles(F.col("embedding")).alias("x"))
    out = plugins.transformed(rows, load, "vec_id bigint, label int, x array<double>, status string, error string")
    return out.select("vec_id", "status", "error", F.posexplode("x").alias("pos", "v"))


def q31_video_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rate = F.when(F.col("event_id") % 7 == 0, "0/0").when(F.col("event_id") % 3 == 0, "30000/1001").when(F.col("event_id") % 3 == 1, "25/1").otherwise(F.col("user_id").cast("string"))
    probe = F.concat_ws(",", (F.get_json_object("props", "$.k").cast("int") * 16).cast("string"), (F.get_json_object("props", "$.k").cast("int") * 9).cast("string"), rate)
    parts = e.select("event_id", F.split(probe, ",").alias("p"))
    field = lambda k: F.get("p", F.lit(k))
    return parts.select("event_id", field(0).cast("int").alias("width"), field(1).cast("int").alias("height"), field(2).alias("r_frame_rate"), txt.ratio(field(2)).alias("fps"))


def q32_chunk_set_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return pending.split_policy(turns, "conv_id", F.length("text") > 300, F.max("turn") + 1)


def q33_summary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"), (F.length("text") > 300).alias("ok"))
    return summary.summary_document(rows, "conv_id", "turn", ["turn", "role", "chars", "ok"])


def q34_wav_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = _waves(spark, sf_dir).select("vec_id", sig.channels(F.transform("x", lambda v: v * 4), 2, 32).alias("channels"))
    read = files.wav_decoded(files.wav_encoded(two, ["vec_id"], "channels", 48000), ["vec_id"], offset=4, frames=20)
    rows = read.select("vec_id", "channel", "sample_rate", F.posexplode("samples").alias("pos", "v"))
    return rows.select("vec_id", "channel", "sample_rate", "pos", F.col("v").cast("double").alias("v"))


def q35_final_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    track = lambda rows, value, name: rows.groupBy("conv_id").agg((value).alias(name))
    tracks = [
        track(turns, (F.max("turn") - F.min("turn") + 1) * 30.0, "video_s"),
        track(turns, F.sum("chars") / 16.0, "audio_s"),
        track(turns.where("role = 'user'"), F.sum("chars") / 16.0, "es_s"),
        track(turns.where("role = 'assistant'"), F.sum("chars") / 16.0, "en_s"),
    ]
    names = ["video_s", "audio_s", "es_s", "en_s"]
    return mux.streams(mux.muxed(tracks, "conv_id", names), "conv_id", names)


def q36_done_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = new_path(spark, "done")
    sizes = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    pending.mark_done(sizes.where("doc_id % 2 = 0"), "doc_id", "n_chars", done)
    pending.mark_done(sizes.where("doc_id % 3 = 0"), "doc_id", "n_chars", done)
    return pending.pending(talks(spark, sf_dir), pending.marked_done(spark, done, "doc_id bigint"), "doc_id").select("doc_id", "n_chars")


def q37_report_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return talks(spark, sf_dir).select("doc_id", txt.minutes_text(F.col("duration_s")).alias("minutes"), txt.gigabytes_text(F.col("n_chars") * F.lit(float(1 << 20))).alias("size"))


def q38_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    given = F.when(F.col("event_id") % 3 == 0, F.lit("")).when(F.col("event_id") % 3 == 1, F.col("event_type"))
    asked = F.element_at(F.array(*map(F.lit, sig.METHODS)), (F.col("user_id") % 4 + 1).cast("int"))
    return e.select("event_id", txt.setting(given, "safe").alias("audio_mode"), txt.setting(F.lit(""), "300").alias("chunk_seconds"), asked.alias("asked_method"), sig.checked_method(asked).alias("used_method"))


def micro(v: Column) -> Column:
    """Millionths, halves to even: for sums that two engines add in different orders."""
    return F.rint(v * 1e6).cast("bigint")


def q39_filtered_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signal through the recurrent filters of the chain of its profile."""
    talk = F.col("talk")
    profile = F.when(talk % 3 == 0, "none").when(talk % 3 == 1, "gentle").otherwise("hum")
    chain = F.regexp_replace(filters.pre_clean(profile, F.lit(50), talk % 2 == 0, F.lit("")), ",?afftdn=[^,]*", "")
    chunks = _talk_chunks(spark, sf_dir, 96).withColumn("chain", chain)
    return _samples(recurrent.filtered(chunks, ["talk"], 48000, F.col("chain")))


def _long_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(talk, start, samples): a hundred vectors after one another are a signal of 4,000 samples a second, each vector a chunk.

    Parts of it are quieter, some by far."""
    scale = F.get(F.array(*map(F.lit, (1.0, 0.3, 0.02, 0.00005))), (F.floor(F.col("vec_id") / 16) % 4).cast("int"))
    return _waves(spark, sf_dir).select(F.floor(F.col("vec_id") / 100).cast("bigint").alias("talk"), (F.col("vec_id") % 100 * 64).alias("start"), F.transform("x", lambda v: v * scale).alias("samples"))


def q40_resample_sinc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [resampling.sinc_resampled(_talk_chunks(spark, sf_dir, 100), ["talk"], 48000, rate, method).select("talk", F.lit(rate).alias("rate"), "start", F.posexplode("samples").alias("p", "v")) for rate, method in ((16000, "sinc_fast"), (64000, "sinc_best"))]
    return made[0].unionByName(made[1]).select("talk", "rate", (F.col("start") + F.col("p")).alias("pos"), micro(F.col("v")).alias("micro"))


def q41_loudness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = loudness.loudness(_long_signals(spark, sf_dir), ["talk"], 4000, long=6)
    to = loudness.gain(F.col("integrated"), F.col("true_peak"), -24.0, -3.0)
    return found.select("talk", micro(F.col("integrated")).alias("integrated"), micro(F.col("range")).alias("range"), micro(F.col("true_peak")).alias("true_peak"), micro(to).alias("gain"))


def _samples(chunks: DataFrame) -> DataFrame:
    rows = chunks.select("talk", "start", F.posexplode("samples").alias("p", "v"))
    return rows.select("talk", (F.col("start") + F.col("p")).alias("pos"), micro(F.col("v")).alias("micro"))


def q42_keyframe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events are a video, every third a keyframe; chunks of a day that begin at keyframes."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.floor(segments.micros("ts") / 1_000_000).alias("s"))
    whole = e.groupBy("user_id").agg(F.min("s").alias("first"), (F.max("s") - F.min("s") + 1).alias("duration"))
    keyframes = e.where("event_id % 3 = 0").join(whole, "user_id").select("user_id", (F.col("s") - F.col("first")).alias("at")).distinct()
    return segments.keyframe_chunks(whole.select("user_id", "duration"), keyframes, "user_id", 86400)


def q43_limited_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud = _talk_chunks(spark, sf_dir, 96).withColumn("samples", F.transform("samples", lambda v: v * 4))
    return _samples(dynamics.limited(loud, ["talk"], 1000.0, attack=0.006))


def q44_speech_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech.speech_segments(_long_signals(spark, sf_dir), ["talk"], 80, 2_000_000, 20_000, pause=3, least=4)


def q45_denoised_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _samples(spectral.denoised(_talk_chunks(spark, sf_dir, 96), ["talk"], 6.0, -12.0, frame=16))


def q46_wav_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of two channels written as WAV files of forty vectors each, committed together, and read again from a frame on, by ranges."""
    chunks = _waves(spark, sf_dir).select(F.floor(F.col("vec_id") / 40).cast("bigint").alias("talk"), (F.col("vec_id") % 40 * 32).alias("start"), F.posexplode(sig.channels(F.transform("x", lambda v: v * 4), 2, 32)).alias("channel", "samples"))
    folder = new_path(spark, "wav")
    media.write_wav_chunks(chunks, "talk", 48000, folder)
    read = media.wav_ranges(spark, folder, offset=100, frames=900, range_bytes=2000)
    # The talk is found once a row of the file, not once a sample.
    named = read.select(F.regexp_extract("path", r"(\d+)\.wav$", 1).cast("bigint").alias("talk"), "sample_rate", "channel", "start", "samples")
    rows = named.select("talk", "sample_rate", "channel", "start", F.posexplode("samples").alias("p", "v"))
    return rows.select("talk", "sample_rate", "channel", (F.col("start") + F.col("p")).alias("pos"), F.col("v").cast("double").alias("v"))


def q47_translated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn's text through a translator that is loaded once a task and sees each distinct text once."""

    def load():
        """Stands for a model: other vowels."""
        return lambda texts: texts.map(lambda t: t.translate(str.maketrans("aeiou", "uoiea")))

    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), F.col("text").alias("content"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), F.lit(-1).alias("turn"), F.concat_ws("\n", F.col("lang"), F.col("source")).alias("content"))
    return subtitles.translated_once(turns.unionByName(docs), "content", load).select("conv_id", "turn", "content")


def q48_fatal_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items, their labels as chunks, their languages as modes."""
    chunks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(chunks, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_chunks"), pending.fatal(F.col("n"), F.col("lang"), ("en", "es", "de")).alias("fatal"))


def q49_chain_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loud signals through a chain with recurrent filters before and after a limiter."""
    loud = _talk_chunks(spark, sf_dir, 96).withColumn("samples", F.transform("samples", lambda v: v * 4))
    return _samples(chains.applied(loud, ["talk"], 1000, "highpass=f=70,lowpass=f=300,alimiter=limit=0.5,anull,bandreject=f=50:w=8"))


def q50_converted_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _samples(resampling.converted(_stereo(spark, sf_dir).withColumnRenamed("vec_id", "talk"), ["talk"], "left", "right", 44100))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        q01_discover_talks, q02_probe_duration, q03_segment_fixed, q04_chunk_progress, q05_skip_policies, q06_pending_chunks, q07_ordered_concat, q08_mux_two, q09_mux_four, q10_srt_document,
        q11_srt_cues, q12_srt_translate_roundtrip, q13_language_route, q14_package_lookup, q15_batch_summary, q15b_batch_json, q16_regen_decisions, q17_filter_chain, q18_container_path, q19_clamp_and_shape, q20_downmix,
        q20b_audio_metadata, q21_resample_linear, q21b_asr_audio, q22_level_normalise, q22b_normalised_samples, q23_progress_eta, q24_crossfade_concat, q25_segment_truncated, q26_segment_overlap, q27_slot_dispatch, q28_mini_batches, q29_prefix_limit, q30_external_transform,
        q31_video_probe, q32_chunk_set_skip, q33_summary_document, q34_wav_round_trip, q35_final_streams, q36_done_table, q37_report_texts, q38_settings, q39_filtered_samples, q40_resample_sinc, q41_loudness,
        q42_keyframe_chunks, q43_limited_samples, q44_speech_segments, q45_denoised_samples, q46_wav_ranges, q47_translated_texts, q48_fatal_checks, q49_chain_samples, q50_converted_audio,
    )
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
