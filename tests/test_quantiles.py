"""Distributed quantiles against numpy, with a hot group and hot values."""

import math

import numpy as np
from pyspark.sql import functions as F

from propval.functions.quantiles import agg_with_quantiles, quantile_row, quantiles


def test_matches_numpy_per_group(spark):
    rng = np.random.default_rng(3)
    rows = [("hot", float(x)) for x in rng.normal(0, 1e4, 5000)] + [("hot", 7.0)] * 4000 + [("narrow", 1000 + x * 1e-9) for x in range(500)]
    rows += [("one", 5.0), ("two", 1.0), ("two", 2.0), (None, -3.5), (None, 0.0), (None, -0.0), ("empty", None), ("big", 1e300), ("big", -1e300), ("big", 1e-300)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    qs = {f"q{int(q * 100):03d}": ("v", q) for q in (0, 0.05, 0.1, 0.5, 0.9, 0.95, 1)}
    got = {r.g: r for r in quantiles(df, ["g"], qs | {"neg": (-F.col("v"), 0.25)}).collect()}
    own = {}
    for g, v in rows:
        if v is not None:
            own.setdefault(g, []).append(v)
    assert set(got) == set(own)
    for g, v in own.items():
        for name, (_, q) in qs.items():
            assert math.isclose(got[g][name], np.quantile(v, q), rel_tol=1e-9, abs_tol=1e-9), (g, name)
        assert math.isclose(got[g]["neg"], np.quantile(-np.array(v), 0.25), rel_tol=1e-9, abs_tol=1e-9)


def test_groups_without_values_and_empty_frames(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "g string, v double")
    got = {r.g: (r.n, r.m) for r in agg_with_quantiles(df, ["g"], [F.count(F.lit(1)).alias("n")], {"m": ("v", 0.5)}).collect()}
    assert got == {"a": (2, None), "b": (1, 1.0)}
    assert quantile_row(df.limit(0), {"m": ("v", 0.5)}) == {"m": None}
    assert agg_with_quantiles(df.limit(0), [], [F.count(F.lit(1)).alias("n")], {"m": ("v", 0.5)}).first().asDict() == {"n": 0, "m": None}


def test_no_group_meets_in_one_task(spark):
    df = spark.range(10).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    plan = quantiles(df, ["g"], {"m": ("v", 0.5)})._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_medians_of_a_stored_frame_are_those_of_quantiles(spark):
    import math

    from propval.functions.quantiles import stored_medians
    rows = [(i, None if i % 5 == 0 else ["a", "b"][i % 2], None if i % 3 == 0 else (i * 7919 % 1009 - 500) / 7.0, [0.0, -0.0, math.inf, -math.inf, math.nan, 1e-310, -5.0][i % 7], None)
            for i in range(2000)]
    d = spark.createDataFrame(rows, "id long, t string, x double, y double, z double").repartition(5)
    want = {r["t"]: r for r in quantiles(d.where("t is not null"), ["t"], {c: (c, 0.5) for c in "xyz"}).collect()}
    got = {r["t"]: r for r in stored_medians(d, ["x", "y", "z"], "t").collect()}
    assert set(got) == {"a", "b"}
    for t, r in got.items():
        assert r["x"] == want[t]["x"] and r["z"] is None and (r["y"] == want[t]["y"] or math.isnan(r["y"]) and math.isnan(want[t]["y"]))
    whole = stored_medians(d, ["x"]).first()
    assert whole["x"] == quantiles(d, [], {"m": ("x", 0.5)}).first()["m"]
