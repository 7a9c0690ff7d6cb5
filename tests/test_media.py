"""WAV files read by ranges and written with a commit."""

import os
import struct

import numpy as np
import pytest
from lectern.sources import files, media
from pyspark.sql import functions as F


def written(folder, name, rate, x, floats=False):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(files.wav_bytes(rate, x, floats))


def joined(df):
    got = {}
    for r in df.collect():
        got.setdefault((os.path.basename(r.path), r.channel), {})[r.start] = r.samples
    out = {}
    for k, parts in got.items():
        at = 0
        for s in sorted(parts):
            assert s == at
            at += len(parts[s])
        out[k] = np.concatenate([parts[s] for s in sorted(parts)])
    return out


@pytest.mark.parametrize("floats", [False, True])
def test_ranges(spark, tmp_path, floats):
    rng = np.random.default_rng(1)
    x = {"a.wav": rng.uniform(-1, 1, (2, 5000)), "b.wav": rng.uniform(-1, 1, (1, 333)), "none.wav": np.zeros((1, 0))}
    for name, v in x.items():
        written(tmp_path, name, 8000, v, floats)
    (tmp_path / "c.txt").write_text("no")
    for offset, frames, size, row in ((0, -1, 1001, 100), (37, 500, 777, 64), (4990, -1, 64 << 20, 1 << 16), (9999, 5, 5000, 100)):
        df = media.wav_ranges(spark, str(tmp_path), offset, frames, size, row)
        got = joined(df)
        want = {(n, c): files.wav_frames(files.wav_bytes(8000, v, floats), offset, frames)[1][c] for n, v in x.items() if v.size for c in range(len(v))}
        assert set(got) == {k for k, v in want.items() if len(v)} and all((got[k] == want[k]).all() for k in got)
    assert media.wav_ranges(spark, str(tmp_path), range_bytes=1001).rdd.getNumPartitions() >= 5000 * 4 // 1001
    assert joined(media.wav_ranges(spark, f"file://{tmp_path}/b.wav")).keys() == {("b.wav", 0)}


class Watched:
    """A file that notes which bytes are read."""

    def __init__(self, data):
        self.data, self.at, self.read_bytes = data, 0, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        part = self.data[self.at : self.at + n]
        self.read_bytes += len(part)
        return part

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass


def test_only_the_wanted_bytes_are_read(monkeypatch):
    data = files.wav_bytes(8000, np.zeros((2, 100_000)))
    file = Watched(data)
    store = type("Store", (), {"open_input_file": lambda self, _: file})()
    monkeypatch.setattr(media, "store_of", lambda p: (store, p))
    reader = media.WavReader({"path": "x", "offset": "50000", "frames": "1000"})
    rows = [b for part in [media.ByteRange("x", len(data), a, min(a + 65536, len(data))) for a in range(0, len(data), 65536)] for b in reader.read(part)]
    assert sum(len(b["samples"][0]) for b in rows) == 1000 and file.read_bytes <= 1000 * 4 + 7 * 200


def test_headers():
    wave = media.header_of(Watched(media.wav_head(48000, 2, 16, 5) + bytes(20)), 64)
    assert (wave.rate, wave.channels, wave.bits, wave.first, wave.frames) == (48000, 2, 16, 44, 5)
    frames = 3 << 30
    head = media.wav_head(48000, 2, 32, frames)
    assert head[:4] == b"RF64" and media.header_of(Watched(head), len(head) + frames * 8).frames == frames
    odd = b"RIFF" + bytes(4) + b"WAVE" + b"LIST" + struct.pack("<I", 3) + b"abc\0" + media.wav_head(8000, 1, 16, 2)[12:] + bytes(4)
    assert media.header_of(Watched(odd), len(odd)).frames == 2
    for bad in (b"OGG", b"RIFF" + bytes(4) + b"WAVE", b"RIFF" + bytes(4) + b"WAVE" + b"data" + bytes(8)):
        with pytest.raises(ValueError):
            media.header_of(Watched(bad), len(bad))


def test_many_small_files_share_partitions(spark, tmp_path):
    """Ranges are dealt in order, each byte once, to a bounded number of partitions; few ranges have one each."""
    for count, size in ((2000, 5000), (50, 5000), (300, 10_000_000), (3, 1 << 31)):
        found = [(f"{k:04d}.wav", size + k) for k in range(count)]
        parts = media.shared_out(found, size * 2 // 5)
        assert [(r.path, b) for p in parts for r in p.ranges for b in (r.low, r.high)] == sorted((r.path, b) for p in parts for r in p.ranges for b in (r.low, r.high))
        held = {}
        for r in (r for p in parts for r in p.ranges):
            assert held.get(r.path, 0) == r.low < r.high
            held[r.path] = r.high
        assert held == dict(found) and len(parts) == 3 * count if count <= 50 else held == dict(found) and len(parts) < 2 * media.PARTITIONS
        assert all(len({r.path for r in p.ranges}) == len(p.ranges) for p in parts)
    assert len(media.shared_out([("long.wav", 1 << 40)], media.RANGE_BYTES)) == (1 << 40) // media.RANGE_BYTES
    rng = np.random.default_rng(4)
    x = {f"{k}.wav": rng.uniform(-1, 1, (2, 300 + k)) for k in range(300)}
    for name, v in x.items():
        (tmp_path / name).write_bytes(files.wav_bytes(8000, v))
    df = media.wav_ranges(spark, str(tmp_path), 7, 250, 500)
    assert df.rdd.getNumPartitions() < 600
    got, want = joined(df), {(n, c): files.wav_frames(files.wav_bytes(8000, v), 7, 250)[1][c] for n, v in x.items() for c in range(2)}
    assert got.keys() == want.keys() and all(np.array_equal(got[k], want[k]) for k in want)


def test_wav_sink(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = {"one": rng.uniform(-2, 2, (2, 700)), "sub/two": rng.uniform(-1, 1, (1, 64))}
    rows = [(k, c, a, v[c, a : a + 100].tolist()) for k, v in x.items() for c in range(len(v)) for a in range(0, v.shape[1], 100)]
    df = spark.createDataFrame(rows, "k string, channel int, start long, samples array<double>").repartition(5)
    for floats in (False, True):
        media.write_wav_chunks(df, "k", 8000, str(tmp_path / "out"), floats)
        for k, v in x.items():
            assert (tmp_path / "out" / f"{k}.wav").read_bytes() == files.wav_bytes(8000, v.T if len(v) > v.shape[1] else v, floats)
    assert sorted(os.listdir(tmp_path / "out")) == ["one.wav", "sub"]


def test_subtitle_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "1\né\n"), (2, ""), (3, None)], "k long, srt string")
    media.write_subtitle_files(df, "k", "srt", f"file://{tmp_path}/s")
    assert {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "s").iterdir()} == {"1.srt": "1\né\n", "2.srt": ""}


def test_nothing_is_seen_of_a_job_that_fails(spark, tmp_path):
    media.write_files(spark.createDataFrame([("a", 0, b"old")], "name string, part long, content binary"), str(tmp_path))
    rows = spark.range(0, 4000, 1, 8).select(F.concat(F.lit("f"), (F.col("id") % 40).cast("string")).alias("name"), F.col("id").alias("part"), F.when(F.col("id") == 3999, F.raise_error(F.lit("stop"))).otherwise(F.lit("x")).cast("binary").alias("content"))
    with pytest.raises(Exception, match="stop"):
        media.write_files(rows, str(tmp_path))
    assert os.listdir(tmp_path) == ["a"] and (tmp_path / "a").read_bytes() == b"old"
    with pytest.raises(Exception, match="not a name"):
        media.write_files(spark.createDataFrame([("ok", 0, b"x"), ("../up", 0, b"x")], "name string, part long, content binary"), str(tmp_path))
    assert os.listdir(tmp_path) == ["a"]


def test_attempts(tmp_path):
    """An attempt that died, one that was repeated, and the one that counts."""
    row = type("Row", (), {})

    def rows(*parts, dies=False):
        for name, content in parts:
            r = row()
            r.name, r.content = name, content
            yield r
        if dies:
            raise KeyboardInterrupt

    writer = media.FilesWriter(str(tmp_path))
    with pytest.raises(KeyboardInterrupt):
        writer.write(rows(("a", b"half"), dies=True))
    writer.write(rows(("a", b"12"), ("a", b"3")))
    message = writer.write(rows(("a", b"12"), ("a", b"3"), ("b", b"")))
    assert [p for p in os.listdir(tmp_path) if p[0] != "_"] == []
    writer.commit([message, None])
    assert {p: (tmp_path / p).read_bytes() for p in os.listdir(tmp_path)} == {"a": b"123", "b": b""}
    other = media.FilesWriter(str(tmp_path))
    other.write(rows(("c", b"x")))
    other.abort([])
    assert sorted(os.listdir(tmp_path)) == ["a", "b"]
