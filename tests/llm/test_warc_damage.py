import gzip
from pathlib import Path

from lectern.llm import warc


def test_damage_to_files_is_located(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FILE_BYTES", 30_000)
    pages = [(k, f"http://h.test/{k}", f"<p>page {k} é</p>" + "word " * (k % 50)) for k in range(300)]
    records = warc.laid_out(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1))
    path = tmp_path / "replica"
    warc.write_files(records, str(path))
    want = {}
    for r in records.orderBy("file", "ordinal").collect():
        want.setdefault(r.file, []).append((r.record + warc.END).encode())
    files = {n: next((path / f"file={n}").glob("*.txt")) for n in want}
    for n, f in files.items():
        assert gzip.decompress(f.read_bytes()) == b"".join(want[n])
    ours = warc.leaves(records)
    assert warc.compared(ours, warc.read_leaves(spark, str(path))).count() == 0

    def starts(data):
        return [k for k in range(len(data)) if data.startswith(warc.MAGIC, k)]

    def rewrite(n, change):
        data = files[n].read_bytes()
        Path(files[n].parent / f".{files[n].name}.crc").unlink(missing_ok=True)
        files[n].write_bytes(change(data, starts(data)))

    assert len(files) >= 4
    rewrite(0, lambda d, at: d[: at[3] + 60] + bytes([d[at[3] + 60] ^ 4]) + d[at[3] + 61 :])  # a byte inside a member
    rewrite(1, lambda d, at: d[: at[5]] + d[at[6] :])  # a record is lost
    rewrite(2, lambda d, at: d[: at[-1] + 40])  # cut off
    rewrite(3, lambda d, at: d[: at[2] + 1] + b"?" + d[at[2] + 2 :])  # the start of a member
    bad = {(r.file, r.ordinal) for r in warc.compared(ours, warc.read_leaves(spark, str(path))).collect()}
    assert bad == {(0, 3), (1, 5), (2, len(want[2]) - 1), (3, 2)}


def test_large_records_have_several_members(monkeypatch):
    data = bytes(range(256)) * 50
    parts = [warc.member(data[k : k + 5000], 7, k // 5000) for k in range(0, len(data), 5000)]
    got = list(warc.split_members(b"".join(parts)))
    assert [k for k, _ in got] == [7] * 3 and b"".join(x for _, x in got) == data
    assert all(p.endswith(b"\0") for p in parts)
