import math
import random

import numpy as np
from pyspark.sql import functions as F

from propval.llm import negatives as ng
from propval.llm.queries import QUERIES


def brute(rows, k=5):
    """rows: (id, label, integer vector), ids all different."""
    out = []
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b))
    last = lambda i: (i is None, i)
    for n, (i, lab, v) in enumerate(rows):
        if i is None or i % 100:
            continue
        scores = [(dot(v, w), j, other) for m, (j, other, w) in enumerate(rows) if m != n]
        positives = sorted((x for x in scores if x[2] == lab), key=lambda x: (-x[0], last(x[1])))[:k]
        for p, j, _ in positives:
            found = sorted((x for x in scores if x[2] != lab and 80 * p <= 100 * x[0] <= 100 * p), key=lambda x: (-x[0], last(x[1])))[:k]
            out += [(i, j, r + 1, x[1], p, x[0]) for r, x in enumerate(found)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


def usable(rows):
    out = []
    for i, v, lab in rows:
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, [math.floor(256 * float(np.float32(x))) for x in v]))
    return out


def table(n=900, dims=7, seed=2):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, 0.1, 0.2, 0.3, rng.random()]) for _ in range(dims)], rng.randrange(3)) for i in range(n)]
    rows += [(n + i, [0.5] * dims, 1) for i in range(300)]                   # one vector and label many times
    rows += [(5000, [-1.0] * dims, 0), (5100, [0.0] * dims, 2), (5200, [0.4, 0.4], 0), (5300, [0.4] * dims, 9), (None, [0.4] * dims, 1)]
    return rows + [(6000, None, 1), (6100, [0.1] * dims, None), (6200, [math.nan] + [0.1] * (dims - 1), 1), (6300, [math.inf] * dims, 1),
                   (6400, [None] + [0.1] * (dims - 1), 0)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, rank int").repartition(3)


def test_against_brute_force_with_small_slabs_and_blocks(spark, monkeypatch):
    rows = table()
    want = brute(usable(rows))
    assert len(want) > 60
    assert got(ng.hard_negatives(frame(spark, rows))) == want
    monkeypatch.setattr(ng, "SLAB", 100)
    monkeypatch.setattr(ng, "LEAF_VALUES", 60)
    monkeypatch.setattr(ng, "BLOCK", 5)
    assert got(ng.hard_negatives(frame(spark, rows))) == want


def test_large_components_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i * 50, i % 2, [rng.randrange(-2**29, 2**29) for _ in range(6)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label int, v array<long>")
    assert got(ng.mine(df, F.col("id") % 100 == 0)) == brute(rows)


def test_boxes_hold_their_rows_and_prune(spark):
    rng = np.random.default_rng(4)
    centres = rng.integers(-200, 200, (12, 6))
    v = np.repeat(centres, 200, axis=0) + rng.integers(-5, 6, (2400, 6))
    rows = spark.createDataFrame([(i, i, i // 200 % 3, [int(x) for x in v[i]]) for i in range(2400)], "rid long, id long, label int, v array<long>")
    leaves = ng.leaves(rows, 6).toArrow().combine_chunks().to_batches()[0]
    tree = ng.Tree(leaves, 6)
    assert sorted(np.concatenate(tree.rids).tolist()) == list(range(2400))
    for low, high, vectors in zip(tree.leaves.low, tree.leaves.high, tree.vectors):
        assert (vectors >= low).all() and (vectors <= high).all()
    q = v[::300]
    lower, upper = tree.leaves.intervals(q)
    for k, vectors in enumerate(tree.vectors):
        products = q @ vectors.T
        assert (products.min(axis=1) >= lower[:, k]).all() and (products.max(axis=1) <= upper[:, k]).all()
    small = [x for x in ng.tiles(np.zeros(2400, int), v, [0, 1, 2], 20)]
    assert sorted(np.concatenate(small).tolist()) == list(range(2400)) and max(map(len, small)) <= 20

    def column(a, kind):
        return ng.pa.array([np.asarray(x, kind).tobytes() for x in a], ng.pa.binary())
    one = ng.pa.RecordBatch.from_pydict({"label": ng.pa.array(np.zeros(len(small), np.int32)), "ids": column(small, np.int64), "rids": column(small, np.int64),
                                         "vectors": column([v[x] for x in small], np.int32), "low": column([v[x].min(axis=0) for x in small], np.int32),
                                         "high": column([v[x].max(axis=0) for x in small], np.int32)})
    anchors = [ng.Anchor(int(i), 0, v[i], [ng.ScoreWindow(-np.inf, np.inf, 5)]) for i in range(0, 2400, 300)]
    read = ng.search(ng.Tree(one, 6), anchors, True)
    assert read < 0.5 * len(small) * len(anchors)                            # most boxes are never opened
    for a in anchors:
        scores = v @ a.vector
        want = [i for i in np.lexsort((np.arange(2400), -scores)) if i != a.rid][:5]
        assert a.windows[0].ids.tolist() == want


def test_empty_table_no_anchor_and_query(spark):
    assert ng.hard_negatives(frame(spark, table()).limit(0)).count() == 0
    assert ng.hard_negatives(frame(spark, [(1, [0.5], 1), (2, [0.5], 2)])).count() == 0
    assert ng.hard_negatives(frame(spark, [(100, [0.5], 1), (2, [0.5], 2)])).count() == 0
    assert got(ng.hard_negatives(frame(spark, [(100, [0.5], 1), (101, [0.5], 1), (2, [0.5], 2), (3, [], 2)]))) == [(100, 101, 1, 2, 16384, 16384)]
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(QUERIES["op11_hard_negatives"](spark, sf)) == brute(usable(rows))
