"""Sample or threshold in one pass, against a plain union."""

import hashlib

import pytest

from propval.operators import extract as X
from propval.plans import q_extract, registry

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("most", [0, X.MOST_CUTS])
def test_sample_or_above_equals_the_union(spark, monkeypatch, most):
    monkeypatch.setattr(X, "MOST_CUTS", most)                        # 0: the cuts aren't broadcast
    states = ["ca"] * 400 + ["tx"] * 5 + [None] * 40 + ["ny"] * 7
    rows = [(i, s, None if i % 17 == 0 else float(i * 37 % 1000)) for i, s in enumerate(states)]
    df = spark.createDataFrame(rows, "id long, state string, price double").repartition(5)
    cuts = X.sample_cuts(df, "state", 6, "id")
    got = sorted(r.id for r in X.sample_or_above(df, cuts, "state", "id", "price", 900.0).collect())
    want = {i for i, _, p in rows if p is not None and p > 900}
    for s in set(states):
        own = sorted((hashlib.md5(f"{i}|42".encode()).hexdigest(), i) for i, t, _ in rows if t == s)
        want |= {i for _, i in own[:6]}
    assert got == sorted(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, state string, price double")
    assert X.sample_or_above(df, X.sample_cuts(df, "state", 3, "id"), "state", "id", "price", 1.0).count() == 0


def test_stratified_extract_scans_like_the_base(spark):
    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan parquet")
    registry.load_all()
    whole = registry.QUERIES["q_stratified_extract"](spark, SMALL)
    assert scans(whole) <= scans(q_extract.base(spark, SMALL)) + 1    # and the cuts


def test_frequency_rank_over_many_ranges(spark):
    from propval.operators.tags import frequency_rank
    rows = [(f"t{i:04d}", i * 7 % 13) for i in range(3000)]
    got = {r.tag: r["rank"] for r in frequency_rank(spark.createDataFrame(rows, "tag string, n_docs long").repartition(6)).collect()}
    assert got == {t: k for k, (t, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert frequency_rank(spark.createDataFrame([], "tag string, n_docs long")).count() == 0
