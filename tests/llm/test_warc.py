import base64
import gzip
import hashlib
import io
import random

import pytest

from propval.llm import warc
from propval.llm.queries import QUERIES


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows, least=0):
    """(id, bytes, digest, type, refers_to) of rows (id, payload) with different ids."""
    best, out = {}, []
    for i, p in rows:
        best[p or ""] = max(best.get(p or "", i), i)
    for i, p in rows:
        body = (p or "").encode()
        one = i if len(body) < least else best[p or ""]
        out.append((i, len(body), digest(body), "response" if one == i else "revisit", None if one == i else one))
    return sorted(out)


def got(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def pages(n=120):
    rng = random.Random(5)
    bodies = ["", "é", "x" * warc.CHUNK, "y" * (warc.CHUNK + 1), "\r\n\r\nWARC/1.1\r\n\r\n", "é" * 50_000, "".join(rng.choice("ab\n ") for _ in range(300_000))]
    rows = [(i, f"http://h/{i}", rng.choice(bodies) if rng.random() < 0.5 else f"<p>{i}</p>" * rng.randrange(3000)) for i in range(n)]
    return rows + [(n, None, None), (n + 1, "http://h/a b\r\nX: y", "z"), (n + 2, "", "same" * 5000)] + [(n + 3 + k, "u", "same" * 5000) for k in range(40)]


def test_round_trip_against_brute_force(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, record long").repartition(4)
    assert got(warc.pages_digest(df)) == brute([(i, p) for i, _, p in rows])


def test_whole_payloads_come_back_in_chunks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE", 2000)             # many archives a task
    rows = pages(40)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = warc.archived(df, "page_id", "url", "html", least=5, folder=str(tmp_path / "out"))
    listed = archives.collect()
    assert len(listed) > 6 and sum(r.records for r in listed) == len(rows)
    back = {}
    for r in sorted(warc.read_chunks(archives).collect(), key=lambda r: (r.record, r.chunk)):
        assert len(r.data) <= warc.CHUNK and r.start == r.chunk * warc.CHUNK
        back.setdefault(int(r.id), []).append(r)
    want = {i: (t, to) for i, _, _, t, to in brute([(i, p) for i, _, p in rows], 5)}
    for i, url, p in rows:
        parts = back[i]
        assert [x.last for x in parts] == [False] * (len(parts) - 1) + [True]
        assert (parts[0].record_type, parts[0].to_id and int(parts[0].to_id)) == want[i]
        body = b"".join(bytes(x.data) for x in parts)
        assert body == ((p or "").encode() if parts[0].record_type == "response" else b"")
        assert hashlib.sha1(body).digest() == bytes(parts[-1].sha1)
        assert (parts[0].url is None) == (url is None)
    text = gzip.decompress(open(listed[0].path, "rb").read())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")


def test_running_digests(spark):
    df = spark.createDataFrame([(1, "ab" * 10_000), (2, ""), (3, "c")], "id long, p string").coalesce(1)
    rows = warc.chunk_table(df, "p", ["id"]).orderBy("record", "chunk").collect()
    assert [(r.id, r.chunk, r.last) for r in rows] == [(1, 0, False), (1, 1, False), (1, 2, True), (2, 0, True), (3, 0, True)]
    assert all(bytes(r.sha1) == hashlib.sha1({1: b"ab" * 10_000, 2: b"", 3: b"c"}[r.id][:r.start + len(r.data)]).digest() for r in rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "u", "a"), (None, "u", "a"), (4, "u", "a"), (4, "u", "a"), (5, "u", "b"), (5, "u", "c"), (None, None, "d"), (None, None, "d")]
    out = got(warc.pages_digest(spark.createDataFrame(rows, "page_id long, url string, html string")).fillna({"page_id": -1}))
    a, b, c, d = (digest(x) for x in (b"a", b"b", b"c", b"d"))
    key = lambda r: (r[0], r[2], r[3], r[4] is None)
    assert sorted(out, key=key) == sorted([(-1, 1, a, "revisit", 4), (-1, 1, a, "revisit", 4), (4, 1, a, "response", None), (4, 1, a, "revisit", 4),
                                           (5, 1, b, "response", None), (5, 1, c, "response", None), (-1, 1, d, "response", None),
                                           (-1, 1, d, "revisit", None)], key=key)


def test_damaged_archives_are_refused():
    head = {"payload_bytes": 3, "record_type": "response", "record": 1, "id": 7, "url": "u", "sha1": hashlib.sha1(b"abc").digest(), "to_record": None, "to_id": None}
    good = warc.record_head(head) + b"abc\r\n\r\n"
    assert [(c, d, last) for _, c, _, d, _, last in warc.records(io.BytesIO(gzip.compress(good) + gzip.compress(good)))] == [(0, b"abc", True)] * 2
    for bad in (gzip.compress(good.replace(b"abc", b"abd")), gzip.compress(good[:-6]), gzip.compress(good)[:-12], gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(bad)))


def test_empty_table_and_query(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.pages_digest(empty).count() == 0
    sf = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert got(QUERIES["op12_warc"](spark, sf)) == brute(rows)
