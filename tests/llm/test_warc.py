import gzip
import hashlib

import pytest

from tidemark.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    big = "".join(f"<p>{k} é</p>" for k in range(60_000))
    html = [None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "y" * 100, big, big,
            "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9, "\r\n\r\n" * 50, "é" * 60, "é" * 60]
    rows = [(k, f"http://a.example/{k}", h) for k, h in enumerate(html)]
    rows += [(None, None, "y" * 100), (4, "http://a.example/4", "y" * 100),
             (None, "http://b\r\nX: 1", "z" * 200), (None, None, "z" * 200)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows):
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    for k in order:
        body = (rows[k][2] or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        again = len(body) >= 100 and digest in first
        out.append((rows[k][0], len(body), digest, "revisit" if again else "response",
                    first[digest] if again else None))
        first.setdefault(digest, rows[k][0])
    return out


def sort(rows):
    return sorted(map(tuple, rows), key=lambda t: tuple((x is None, x) for x in t))


def test_round_trip(pages):
    assert sort(warc.round_trip(pages).collect()) == sort(expected(pages.collect()))
    assert warc.round_trip(pages.where("false")).count() == 0


def test_payload_is_streamed_in_chunks(pages, spark):
    files = warc.write_archives(pages, chunk=1000)
    rows = warc.read_archives(files, chunk=1000).collect()
    whole = {}
    for r in sorted(rows, key=lambda r: (r["record_id"], r["chunk_no"])):
        part = whole.setdefault(r["record_id"], b"") + (r["data"] or b"")
        whole[r["record_id"]] = part
        assert len(r["data"] or b"") <= 1000
        if r["record_type"] == "response":      # the digest so far
            assert r["payload_digest"] == hashlib.sha256(part).hexdigest()
            assert r["payload_bytes"] == len(part)
    bodies = {hashlib.sha256(b).hexdigest() for b in whole.values()}
    assert {hashlib.sha256((r["html"] or "").encode()).hexdigest()
            for r in pages.collect()} <= bodies


def test_files_are_warc(pages):
    paths = [r["path"] for r in warc.write_archives(pages).collect()]
    fs, place = warc.file_system(paths[0])
    with fs.open_input_stream(place, compression=None) as f, gzip.GzipFile(fileobj=f) as z:
        data = z.read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    assert b"\nX: 1" not in data


def test_archives_roll(pages, spark, monkeypatch, tmp_path):
    archive = warc.Archive(str(tmp_path), roll=10)
    head = {"record": 1, "page_id": 1, "url": None, "bytes": 3, "refers_to": None,
            "digest": hashlib.sha256(b"abc").hexdigest(), "first_record": None}
    for k in range(3):
        assert archive.record({**head, "record": k})
        archive.write(archive.zip.compress(b"abc"))
        archive.end()
    archive.close()
    assert [n for _, n in archive.done] == [1, 1, 1]
    rows = [r for p, _ in archive.done for r in warc.records(p)]
    assert [r[8] for r in rows] == [b"abc"] * 3


def test_damage_is_found(tmp_path):
    archive = warc.Archive(str(tmp_path))
    archive.record({"record": 1, "page_id": 1, "url": None, "bytes": 3, "refers_to": None,
                    "digest": "0" * 64, "first_record": None})
    archive.write(archive.zip.compress(b"abc"))
    archive.end()
    archive.close()
    with pytest.raises(ValueError, match="differs"):
        list(warc.records(archive.done[0][0]))
