import re
from fractions import Fraction

import pytest

from propval.llm import mixing, queries

WORD = re.compile("[^\x20\x09-\x0D]+")


def apportion(claims, most, blocks):
    """Sainte-Laguë, block by block."""
    seats = [0] * len(claims)
    for _ in range(min(blocks, sum(most))):
        q = [Fraction(c) / (2 * s + 1) if s < m else Fraction(-1) for c, s, m in zip(claims, seats, most)]
        seats[q.index(max(q))] += 1
    return seats


def test_apportion_matches_block_by_block(spark, rng):
    for _ in range(3):
        claims = [rng.randint(1, 5000) for _ in range(25)] + [300, 300, 300, 300]
        most = [max(1, 3 * c // mixing.BLOCK_WORDS) if rng.random() < 0.8 else c // 40 for c in claims]
        blocks = round(sum(claims) / mixing.BLOCK_WORDS) - rng.randint(0, 9)
        rows = [(f"s{i:03d}", 0, float(c), m) for i, (c, m) in enumerate(zip(claims, most))]
        df = spark.createDataFrame(rows, "source string, shard long, claim double, most long")
        got = {r.source: r.quota for r in mixing.apportion(df, blocks).collect()}
        assert [got[r[0]] for r in rows] == apportion(claims, most, blocks)


def test_targets():
    assert mixing.targets([]) == {}
    t = mixing.targets([("b", 100), ("a", 100), (None, 100)])
    assert t == pytest.approx({"a": 50.0, "b": 100.0, None: 150.0})
    t = mixing.targets([("a", 1000), ("b", 10), ("c", 0)])        # b and c stop at 3 times their size
    assert t == pytest.approx({"a": 980.0, "b": 30.0, "c": 0.0})


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, source string, text string" + more)


def check(rows, got):
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in got) == sorted((str(d), str(s), size(t)) for d, s, t in rows)
    own = {}
    for _, s, t in rows:
        own[s] = own.get(s, 0) + size(t)
    target, taken = mixing.targets(list(own.items())), {}
    for r in got:
        assert r.source_size == own[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        shards = -(-own[s] // mixing.SHARD_WORDS)
        assert abs(n - target[s]) <= max(2, shards + 1) * mixing.BLOCK_WORDS
    return taken


def test_rows_and_reruns(spark, rng, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 600)
    rows = [(i, rng.choice(["a", "b", "hot", "hot", "hot", None, "z"]), "w " * rng.randint(0, 60)) for i in range(400)]
    rows += [(3, "a", "same text"), (3, "a", "same text"), (None, "a", "x y"), (None, None, None), (900, "tiny", "one two"), (901, "long", "w x\ty " * 4000), (902, "empty", "")]
    got = mixing.mix(frame(spark, rows).repartition(5)).collect()
    check(rows, got)
    again = mixing.mix(frame(spark, rows[::-1]).repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_rows_keep_columns_and_copies(spark):
    rows = [(1, "a", "x y z " * 20, 1)] * 3 + [(2, "b", "u v w " * 20, 2), (None, "b", "n " * 30, 4)]
    df = frame(spark, rows, ", taken int")
    got = mixing.mixed_rows(df).collect()
    every = mixing.mix(df).collect()
    assert sorted((str(r.doc_id), r.taken) for r in got) == sorted((str(r.doc_id), r.taken) for r in every if r.taken)


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [(1, "a", "b")]).limit(0)).count() == 0


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    taken = check(rows, queries.QUERIES["op10_mixing"](spark, sf).collect())
    assert abs(sum(taken.values()) - sum(len(WORD.findall(t)) for _, _, t in rows)) <= mixing.BLOCK_WORDS
