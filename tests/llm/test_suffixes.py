"""Suffix-array dedup against brute force over every 100-byte string."""

import hashlib

import pytest

from propval.llm import queries, suffixes


def brute(rows):
    docs = sorted({(i if i is not None else -(1 << 63), t or "") for i, t in rows})
    seen, out = set(), {}
    for i, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i, t] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return [((r.doc_id if r.doc_id is not None else -(1 << 63), r.text or ""), (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
            for r in suffixes.deduplicate(df).collect()]


@pytest.mark.parametrize("bucket_rows", [100_000, 20])
def test_matches_brute_force(spark, rng, monkeypatch, bucket_rows):
    monkeypatch.setattr(suffixes, "BUCKET_ROWS", bucket_rows)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(30), prose(60), "x" * 400, "ab " * 90, prose(25) + "\0\0" + prose(25)]
    rows = [(i, " ".join(rng.choice([prose(rng.randint(0, 40)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 40):]])
                         for _ in range(rng.randint(0, 5)))) for i in range(120)]
    rows += [(200 + i, rows[i % 7][1]) for i in range(15)] + [(5, rows[5][1]), (7, "other " + shared[1]), (None, shared[0]), (None, None), (300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    got = result(df)
    assert len(got) == len(rows)
    for key, value in got:
        assert value == want[key], key


def test_clean_text_stays_and_empty_table(spark):
    df = spark.createDataFrame([(1, "short"), (2, "short")], "doc_id long, text string")
    assert {r.n_removed for r in suffixes.deduplicate(df).collect()} == {0}
    assert suffixes.deduplicate(df.limit(0)).count() == 0


def test_clashing_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "a", "z", 5, 9)], "doc_id long, text string, n_bytes string, doc int, place int")
    row = suffixes.deduplicate(df).collect()[0].asDict()
    assert row["n_bytes"] == 1 and row["doc"] == 5 and row["place"] == 9


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {k[0]: v for k, v in brute(rows).items()}
    for r in queries.QUERIES["op9_suffix_array_dedup"](spark, sf).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


def test_texts_under_one_id_are_told_apart_by_the_whole_hash(spark):
    texts = spark.range(20_000).selectExpr("concat(sha2(cast(id as string), 512), sha2(concat(id, 'x'), 512)) as text")
    by_bits = {}
    for r in texts.selectExpr("text", "xxhash64(text) & ((1 << 25) - 1) as bits").collect():
        by_bits.setdefault(r.bits, []).append(r.text)
    pairs = [x for x in by_bits.values() if len(x) > 1]
    assert pairs                                          # texts whose hashes agree in 25 bits
    rows = [row for i, (a, b, *_) in enumerate(pairs) for row in ((2 * i, a), (2 * i + 1, a), (2 * i + 1, b))]
    rows += [(None, r.text) for r in texts.limit(3000).collect()] + [(None, rows[0][1])]
    want = brute(rows)
    for key, value in result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)):
        if key[1] != rows[0][1] or key[0] >= 0:
            assert value == want[key], key
    assert all(want[2 * i + 1, b][1] == 0 for i, (_, b, *_) in enumerate(pairs) if (None, b) not in rows)
