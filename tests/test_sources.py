"""Files in and out, and the streams."""

import os

import pytest
from lectern.sources import files
from lectern.streaming import chunks
from pyspark.sql import functions as F


def test_discovery(spark, tmp_path):
    for name, size in (("talk_b.mp4", 2000), ("talk_a.mp4", 5), ("other.txt", 9)):
        (tmp_path / name).write_bytes(b"x" * size)
    got = files.discovered(spark, str(tmp_path), "*.mp4").orderBy("name").collect()
    assert [(r.name, r.stem, r.size) for r in got] == [("talk_a.mp4", "talk_a", 5), ("talk_b.mp4", "talk_b", 2000)]
    assert files.discovered(spark, str(tmp_path), "*.mp4", min_bytes=1024).count() == 1
    with pytest.raises(FileNotFoundError):
        files.discovered(spark, str(tmp_path), "*.mkv")


def test_subtitles_and_json(spark, tmp_path):
    (tmp_path / "a.srt").write_text("1\n00:00:00,000 --> 00:00:01,000\nhé\n", encoding="utf-8")
    (tmp_path / "a.json").write_text('{"result":\n {"language": "en"}}')
    assert files.subtitle_files(spark, str(tmp_path)).first().srt.endswith("hé\n")
    assert "language" in files.json_files(spark, str(tmp_path)).first().json
    docs = spark.createDataFrame([(1, "1\na\n"), (2, "\n")], "k long, srt string")
    files.write_documents(docs, "k", "srt", str(tmp_path / "out"))
    assert {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("part-*")} == {"k=1": "1\na\n", "k=2": "\n"}
    files.write_summary(spark.createDataFrame([(1, "é")], "k long, t string"), str(tmp_path / "sum"))
    assert '{"k":1,"t":"é"}' in "".join(p.read_text() for p in (tmp_path / "sum").glob("part-*"))


def test_wav(spark, tmp_path):
    import numpy as np

    x = np.array([[0.0, 0.5, -1.0, 1.0, 2.0], [0.25, -0.25, 0.125, -2.0, 0.0]])
    for floats in (False, True):
        content = files.wav_bytes(48000, x, floats)
        rate, got = files.wav_frames(content)
        want = np.clip(x, -1, 1) if floats else np.rint(np.clip(x, -1, 1) * 32767) / 32768
        assert rate == 48000 and got.dtype == np.float32 and got.shape == (2, 5) and np.array_equal(got, want.astype(np.float32))
        assert np.array_equal(files.wav_frames(content, 1, 3)[1], got[:, 1:4]) and files.wav_frames(content, 9)[1].shape == (2, 0)
    assert files.wav_frames(files.wav_bytes(8000, x[0]))[1].shape == (1, 5)
    assert files.wav_info(files.wav_bytes(8000, np.zeros((20, 2))))[1] == 2
    with pytest.raises(ValueError, match="dimensions"):
        files.wav_bytes(8000, np.zeros((1, 2, 3)))
    with pytest.raises(ValueError, match="not a WAV"):
        files.wav_info(b"junk" * 10)
    signals = spark.createDataFrame([("in/a.b.wav", x.tolist())], "path string, channels array<array<double>>")
    named = files.wav_encoded(signals, ["path"], "channels", 48000).withColumn("path", files.wav_name(F.col("path"), "enhanced", str(tmp_path)))
    assert [(r.path, r["size"]) for r in files.write_wav_files(named, "path").collect()] == [(f"{tmp_path}/a.b_enhanced.wav", 44 + 20)]
    assert [p.name for p in tmp_path.iterdir()] == ["a.b_enhanced.wav"]
    got = {r.channel: r for r in files.wav_files(spark, str(tmp_path), 1, 3).collect()}
    assert [round(v * 32768) for v in got[0].samples] == [16384, -32767, 32767] and got[1].sample_rate == 48000


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from lectern.sources import shared

    conf = lambda **kv: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: kv.get(k.replace(".", "_"), d)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(conf(spark_master="spark://host:7077"))
    assert shared.shared_folder(conf(spark_master="yarn", spark_checkpoint_dir="s3a://x/y")) == "s3a://x/y"


def test_streams(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    rows = chunks.events(spark, str(tmp_path / "in"), files_each=10)
    q = chunks.chunk_counts(rows, 300).writeStream.format("memory").queryName("chunk_counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = events.groupBy(F.window(F.col("ts").cast("timestamp"), "300 seconds").start.alias("chunk_start")).count()
    assert sorted(map(tuple, spark.table("chunk_counts").collect())) == sorted(map(tuple, want.collect()))
    once = chunks.pending_once(rows, "event_id").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    once.awaitTermination(120)
    assert spark.table("once").count() == events.count()


def test_scratch_can_be_dropped(spark):
    from lectern.sources import shared

    spark = spark.newSession()  # the other tests' tables stay
    at = shared.new_path(spark, "x")
    assert at.startswith(shared.run_folder(spark) + "/x-")
    spark.range(3).write.parquet(at)
    assert spark.read.parquet(at).count() == 3
    assert shared.drop_run(spark) and not shared.drop_run(spark)
    assert not os.path.exists(at.removeprefix("file://"))
    assert shared.new_path(spark, "x").rsplit("/", 1)[0] != at.rsplit("/", 1)[0]
