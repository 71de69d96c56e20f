"""Steps that run once, however many passes follow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from propval.operators import tags as TG
from propval.operators import topics as TP
from propval.sources import fixtures as fx

VALUES = ["x: None, 'a None, b': [None , True],:\n\t False}", "{'a':None}", "[ None]", "Nonesuch: None x, None]", ":  None,None", None, "None,", ":TrueFalse,True}", ": " + " " * 2000 + "None}"]


def test_image_text_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([(1, 1, 1, 1, 0.1, 0.1, "O")], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double, l_tax double, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "large ring")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    long = TG.explode_tags(fx.tagged(spark, str(tmp_path)))
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("None(?=") == 1
    assert [tuple(r) for r in long.collect()] == [(1, "large ring")]


def test_literals_are_those_of_the_pattern_by_character(spark):
    old = F.col("t")
    for a, b in (("None", "null"), ("True", "true"), ("False", "false")):
        old = F.regexp_replace(old, rf"(?<=[:\[,])(\s*){a}(?=\s*[,}}\]])", f"$1{b}")
    d = spark.createDataFrame([(v,) for v in VALUES], "t string").select(TG.python_literals_to_json(F.col("t")).alias("n"), old.alias("o"))
    assert d.where("not (n <=> o)").count() == 0 and d.where("n = o").count() == len(VALUES) - 1


def test_combinations_drop_other_tags_before_the_shuffle(spark):
    rows = [(1, ["a", "b", "x"]), (1, ["c", None]), (2, ["b", "a", "a"]), (None, ["a", "c"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "property_id long, tags array<string>")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",)], "tag string")
    counts = TG.combo_counts(df, vocab, 2)
    assert {(r.feature_1, r.feature_2): r["count"] for r in counts.collect()} == {("a", "b"): 2, ("a", "c"): 2, ("b", "c"): 1}
    assert "Join" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_lda_iterations_dont_derive_the_texts_again(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def words(i):
        seen.add(1)
        return [f"w{i % 7}", f"w{i % 5}"]
    docs = spark.range(200, numPartitions=2).select(F.col("id").alias("property_id"), words("id").alias("tags"))
    TP.lda_topics(docs, 3, 10)
    assert seen.value <= 5 * 200                           # 20 iterations


def plain_sweep(idx, z, u, counts, alpha, beta):
    mz, nz, nzw = counts
    out = []
    for words, old, at in zip(idx, z, u, strict=True):
        words = np.asarray(words, int)
        mz[old], nz[old] = mz[old] - 1, nz[old] - len(words)
        nzw[old, words] -= 1
        log_p = np.log(mz + alpha) + np.log(nzw[:, words] + beta).sum(axis=1) - np.log(nz[:, None] + nzw.shape[1] * beta + np.arange(len(words))).sum(axis=1)
        p = np.cumsum(np.exp(log_p - log_p.max()))
        new = int(np.searchsorted(p, at * p[-1], "right").clip(0, len(p) - 1))
        mz[new], nz[new] = mz[new] + 1, nz[new] + len(words)
        nzw[new, words] += 1
        out.append(new)
    return out


def mixture(n, longest, seed=0):
    rng = np.random.default_rng(seed)
    docs = [np.sort(rng.choice(80, rng.integers(0, longest), replace=False)).tolist() for _ in range(n)]
    z = rng.integers(0, 5, n).tolist()
    words = np.zeros((5, 80))
    for d, k in zip(docs, z):
        words[k, d] += 1
    counts = lambda: (np.bincount(z, minlength=5).astype(float), words.sum(axis=1), words.copy())
    return docs, z, rng.random(n).tolist(), counts


@pytest.mark.parametrize("longest, beta", [(8, 0.1), (60, 0.1), (30, 1e-14)])
def test_sweep_draws_what_a_plain_loop_draws(longest, beta):
    docs, z, u, counts = mixture(500, longest)
    a, b = counts(), counts()
    assert TP.gsdmm_sweep(docs, z, u, a, len(docs), 0.1, beta) == plain_sweep(docs, z, u, b, 0.1, beta)
    assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_sweep_of_short_documents_is_additions_and_products():
    import time
    docs, z, u, counts = mixture(6000, 8)

    def best(f):
        times = []
        for _ in range(3):
            c, start = counts(), time.process_time()
            f(c)
            times.append(time.process_time() - start)
        return min(times)
    assert 1.7 * best(lambda c: TP.gsdmm_sweep(docs, z, u, c, len(docs), 0.1, 0.1)) < best(lambda c: plain_sweep(docs, z, u, c, 0.1, 0.1))


def test_nmf_reads_the_entries_of_a_batch_flat():
    import pyarrow as pa
    rng = np.random.default_rng(4)
    idx = [sorted(rng.choice(20, rng.integers(0, 6), replace=False).tolist()) for _ in range(40)]
    val = [rng.random(len(i)).tolist() for i in idx]
    H = rng.random((3, 20))
    batch = pa.RecordBatch.from_pydict({"idx": pa.array(idx, pa.list_(pa.int32())), "val": pa.array(val, pa.list_(pa.float64()))}).slice(5, 30)
    w, doc = TP.nmf_solve(*TP._entries(batch), H, 0.1, 0.2)
    again, doc_again, *_ = TP.nmf_weights(idx[5:35], val[5:35], H, 0.1, 0.2)
    assert np.array_equal(w, again) and np.array_equal(doc, doc_again) and len(w) == 30


def test_counts_of_terms_are_written_out_once(spark):
    from propval.operators import text as TX
    docs = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["c"]), (3, [])], "property_id long, tokens array<string>")
    counts = TX.doc_term_counts(docs, 2)
    assert {(r.property_id, r.term): r["count"] for r in counts.collect()} == {(1, "b"): 2, (1, "a"): 1}
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("array_sort") == 1


def test_no_two_models_meet_in_a_task(spark):
    from propval.operators import boosting as B
    names = [f"d{d}|{t}" for d in (6, 8, 10, 12, 14, 16) for t in range(3)]
    at = spark.createDataFrame([(n,) for n in names], "name string").repartition(B._apart(spark, names), "name").select(F.spark_partition_id().alias("p"))
    assert at.distinct().count() == len(names)
    assert B._apart(spark, ["a"]) == 1 == B._apart(spark, [""])


def test_both_searches_find_the_same_splits():
    from propval.operators import boosting as B
    rng = np.random.default_rng(6)
    bins = np.minimum(rng.integers(0, 90, (900, 5)), B.BINS - 1)
    own, up = rng.integers(0, 60, 900), rng.integers(0, 2, 900)
    own[own == 17] = 18                                    # a node without rows
    places = bins + np.arange(5) * B.BINS
    for s, least in ((B.Spec("m", loss="pinball"), 3.0), (B.Spec("m", loss="pinball", l1=0.5, l2=0.0), 1.0)):
        a, x = B._best_dense(own, places, 0.5 - up, np.ones(900), 60, s, least)
        b, y = B._best_sorted(own, places, up, 0.5, 60, s, least)
        assert np.array_equal(a[a > 1e-12], b[a > 1e-12]) and np.array_equal(x[a > 1e-12], y[a > 1e-12]) and (b[a <= 1e-12] <= 1e-12).all()
        assert (a > 1e-12).sum() > 30


@pytest.mark.parametrize("buckets, top", [(64, 1), (64, 3), (5000, 20), (7, 2000)])
def test_vocabulary_by_buckets_is_the_whole_one(spark, monkeypatch, buckets, top):
    from propval.operators import text as TX
    rng = np.random.default_rng(4)
    # a few frequent terms, many rare ones that fill their buckets, ties
    rows = [(i, [f"w{int(t)}" for t in rng.zipf(1.3, 12) % 700] + [f"u{i}", f"u{i // 2}"]) for i in range(600)]
    docs = spark.createDataFrame(rows, "property_id long, tokens array<string>").repartition(3)
    want = TX.vocabulary(docs, top)
    monkeypatch.setattr(TX, "DIRECT", 0)
    monkeypatch.setattr(TX, "BUCKETS", buckets)
    assert TX.vocabulary(docs, top) == want and want[1] == 600
