"""Stored bridge, label levels in one pass, and documents tokenised once."""

from __future__ import annotations

from pyspark.sql import functions as F

from propval.operators import extract as X
from propval.operators import features as FE
from propval.operators import text as TX
from propval.sources.io import output_dir, write_bucketed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bridge_side_of_a_join_has_no_exchange(spark):
    address = spark.createDataFrame([(["1", "2"], ["a"]), (["2"], ["a", "b"]), ([], ["c"]), (["3"], None)], "mls_ids array<string>, assessor_ids array<string>")
    bridge = write_bucketed(X.id_bridge(address), "test_bridge", ["mls_id"], 4)
    listings = spark.createDataFrame([(1, 10.0, None), (2, None, None), (3, 5.0, None)], "cc_list_id long, price double, a_date date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bridge.join(listings.withColumn("mls_id", F.col("cc_list_id").cast("string")), "mls_id")
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1     # the listings' side
        assert "Bucketed: true" in joined._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        rows = {r["assessor_id"]: (r["n_listings"], r["n_priced"], r["max_price"]) for r in X.listings_by_property(bridge, listings).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == {"a": (2, 1, 10.0), "b": (1, 0, None)}


def test_bridge_written_again_replaces_the_table(spark):
    path = output_dir(spark, "bridge")
    for n in (3, 5):
        t = write_bucketed(spark.range(n).withColumn("k", F.col("id") % 2), "test_bridge_again", ["k"], 2, path)
        assert t.count() == n


def test_label_levels_at_the_limit_nulls_and_empty(spark):
    d = spark.range(400).select("id", (F.col("id") % 99).cast("string").alias("below"), (F.col("id") % 100).cast("string").alias("at"),
                                F.col("id").cast("string").alias("ids"), F.when(F.col("id") % 2 == 0, "x").alias("nulls"),
                                F.lit(None).cast("string").alias("none")).repartition(7)
    cols = ["below", "at", "ids", "nulls", "none"]
    labels = FE.label_encoding(d, cols)
    assert sorted(labels) == ["below", "none", "nulls"]
    assert len(labels["below"]) == 100 and labels["nulls"] == ["Unknown", "x"] and labels["none"] == ["Unknown"]
    assert FE.label_encoding(d.limit(0), ["below"]) == {"below": ["Unknown"]}
    assert FE.label_encoding(d, []) == {}


def test_label_levels_take_one_job(spark):
    d = spark.range(1000).select((F.col("id") % 7).cast("string").alias("a"), F.col("id").cast("string").alias("b"))
    group = "label-levels"
    spark.sparkContext.setJobGroup(group, group)
    try:
        FE.label_encoding(d, ["a", "b"])
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # adaptive execution submits each of the two shuffles and the result as a job; none is per column
    assert len(jobs) <= 3


def test_documents_tokenise_once_and_counts_agree(spark):
    texts = ["red brick house near red brick mill", "brick house", "", None, "red red red red", "1 2 3", "the a of"]
    d = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "property_id long, c string, p string")
    docs = TX.combined_document(d, "c", "p")
    assert "split(" not in "".join(x for x in _plan(docs).splitlines() if "Filter" in x)
    have = {r["property_id"]: r["tokens"] for r in docs.collect()}
    want = {}
    for i, t in enumerate(texts):
        w = [x for x in (t or "").split() if len(x) > 1 and not x.isdigit() and x not in TX.STOPSET]
        grams = [f"{a}_{b}" for a, b in zip(w, w[1:])] + ["_".join(x) for x in zip(w, w[1:], w[2:])]
        if grams:
            want[i] = grams
    assert have == want
    for top in (1, 3, 50):
        terms = [t for t, _ in TX.vocabulary(docs, top)[0]]
        counts = {(r["property_id"], r["term"]): (r["count"], r["term_index"]) for r in TX.doc_term_counts(docs, top).collect()}
        assert counts == {(i, t): (g.count(t), terms.index(t)) for i, g in want.items() for t in set(g) & set(terms)}


def test_counts_of_no_documents(spark):
    docs = spark.createDataFrame([], "property_id long, tokens array<string>")
    assert TX.doc_term_counts(docs, 5).collect() == [] and TX.tfidf_smooth_from_docs(docs, 5).collect() == []
