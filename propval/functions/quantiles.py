"""Exact quantiles without a group in one task.

A quantile is found by its rank.  Equal values of a group are counted first
(map-side), so a hot value is one row; a histogram over an order-preserving
bucket of the value tells in which bucket a rank lies (at most some ten
thousand buckets to a group, whatever the rows), and only the counted values
of that bucket are put in order.  All groups, columns and quantiles go
through one plan, and both consumers of the counted values read the same
exchange.  The result interpolates linearly between the two neighbouring
order statistics, like pandas, DuckDB and Spark's ``percentile``.

Many columns of a stored frame in few groups go without a shuffle of their
values: :func:`order_statistics` reads the frame once for every eight bits of a
value and counts the next digits of the values that begin like a wanted rank's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BUCKETS_PER_DOUBLING = 1024
SHIFTS = (52, 44, 36, 28, 20, 12, 4, 0)   # the digits of a value: sign and exponent, then eight bits each


def _bucket(v: Column) -> Column:
    """Grows with v: logarithmic on both sides of zero; NaN is the largest."""
    size = F.floor(F.log2(1 + F.abs(v)) * BUCKETS_PER_DOUBLING)
    return F.when(F.isnan(v), F.lit((1 << 62))).otherwise((F.signum(v) * size).cast("long"))


def quantiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[str | Column, float]]) -> DataFrame:
    """``by`` and one double column per name in ``wanted``: the (column,
    q) quantile of the rows where the column is not null."""
    streams: dict[object, tuple[int, Column]] = {}
    asked = []
    for i, (c, q) in enumerate(wanted.values()):
        key = c if isinstance(c, str) else i
        n, _ = streams.setdefault(key, (len(streams), (F.col(c) if isinstance(c, str) else c).cast("double")))
        asked.append(F.struct(F.lit(n).alias("c"), F.lit(i).alias("i"), F.lit(float(q)).alias("q")))
    key = F.struct(F.lit(0).alias("_all"), *[F.col(b) for b in by]).alias("k")
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("c"), v.alias("v")) for n, v in streams.values()])).alias("x")
    # + 0.0 makes -0.0 and 0.0 one value
    counted = (df.select(key, values).select("k", "x.c", (F.col("x.v") + 0.0).alias("v")).where("v is not null")
               .groupBy("k", "c", "v").agg(F.count("*").alias("n")))
    at = Window.partitionBy("k", "c")
    running = at.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (counted.groupBy("k", "c", _bucket(F.col("v")).alias("b")).agg(F.sum("n").alias("n"))
               .select("k", "c", "b", "n", F.sum("n").over(running).alias("to"), F.sum("n").over(at).alias("total")))
    place = (F.col("total") - 1) * F.col("a.q")
    ranks = (buckets.withColumn("a", F.explode(F.array(*asked))).where("a.c = c")
             .withColumn("r", F.explode(F.array(F.floor(place), F.ceil(place)))).withColumn("place", place)
             .where((F.col("r") >= F.col("to") - F.col("n")) & (F.col("r") < F.col("to"))).distinct()
             .select("k", "c", "b", F.col("a.i").alias("i"), "place", "r", (F.col("r") - (F.col("to") - F.col("n"))).alias("rest")))
    inside = Window.partitionBy("k", "c", "b")
    ordered = (counted.withColumn("b", _bucket(F.col("v"))).join(ranks.select("k", "c", "b").distinct(), ["k", "c", "b"], "left_semi")
               .withColumn("to", F.sum("n").over(inside.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    found = (ordered.join(ranks, ["k", "c", "b"]).where((F.col("rest") >= F.col("to") - F.col("n")) & (F.col("rest") < F.col("to"))))
    weight = F.when(F.floor("place") == F.ceil("place"), 1.0).when(F.col("r") == F.floor("place"), F.ceil("place") - F.col("place")).otherwise(
        F.col("place") - F.floor("place"))
    out = found.groupBy("k").agg(*[F.sum(F.when(F.col("i") == i, weight * F.col("v"))).alias(name) for i, name in enumerate(wanted)])
    return out.select(*[F.col(f"k.{b}").alias(b) for b in by], *wanted)


def agg_with_quantiles(df: DataFrame, by: list[str], aggs: list[Column], wanted: dict[str, tuple[str | Column, float]]) -> DataFrame:
    """``df.groupBy(by).agg(aggs)`` with the quantiles in ``wanted`` beside
    them (null for a group without a value)."""
    left = (df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)).withColumn("_k", F.struct(F.lit(0).alias("_all"), *[F.col(b) for b in by]))
    right = quantiles(df, by, wanted)
    right = right.withColumn("_k", F.struct(F.lit(0).alias("_all"), *[F.col(b) for b in by])).drop(*by)
    return left.join(right, "_k", "left").drop("_k")


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str | Column, float]]) -> dict[str, float | None]:
    """The quantiles of the whole of df, as numbers."""
    row = quantiles(df, [], wanted).first()
    return {name: None if row is None else row[name] for name in wanted}


# --------------------------------------------------------------------------
# Many columns, few groups, no shuffle of values
# --------------------------------------------------------------------------

def _ordered(v: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers of the same order; -0.0 is 0.0, NaN the largest."""
    b = np.where(np.isnan(v), np.nan, v + 0.0).view(np.uint64)
    top = np.uint64(1 << 63)
    return np.where(b >= top, ~b, b | top)


def _doubles(u: np.ndarray) -> np.ndarray:
    top = np.uint64(1 << 63)
    return np.where(u >= top, u ^ top, ~u).view(np.float64)


def by_group(batch: pa.RecordBatch, many: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(group, rows, their values, which of these are not null) of a batch of (_g, _x)."""
    flat = batch.column("_x").flatten()
    x, there = flat.to_numpy(zero_copy_only=False).reshape(batch.num_rows, many), flat.is_valid().to_numpy(zero_copy_only=False).reshape(batch.num_rows, many)
    own = batch.column("_g").to_numpy()
    for g in np.unique(own):
        rows = np.flatnonzero(own == g)
        yield int(g), rows, x[rows], there[rows]


def order_statistics(d: DataFrame, many: int, shares: Sequence[float]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the values of each group and place of d (_g: int, _x: ``many`` doubles),
    by group x many + place: the values at the ranks below and above each share
    of them, and where the share lies between the two (0 to 1); exact.  Nothing
    for a place without a value."""
    spark = d.sparkSession
    prefix: dict[int, np.ndarray] = {}                     # the digits so far that a rank has, in order
    need: dict[int, tuple[np.ndarray, np.ndarray]] = {}    # of every rank: place of its digits, rows before it there
    between: dict[int, np.ndarray] = {}
    for k, shift in enumerate(SHIFTS):
        before = SHIFTS[k - 1] if k else 64
        width = before - shift
        shared = spark.sparkContext.broadcast(prefix)

        def counted(batches, k=k, shift=shift, before=before, width=width, shared=shared):
            sums = {}
            for b in batches:
                for g, _, x, there in by_group(b, many) if b.num_rows else ():
                    for f in range(many):
                        at = g * many + f
                        u = _ordered(x[there[:, f], f])
                        digit, cells = (u >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1), 1 << width
                        if k:
                            known = shared.value.get(at)
                            if known is None:
                                continue
                            u = u >> np.uint64(before)
                            place = np.minimum(np.searchsorted(known, u), len(known) - 1)
                            hit = known[place] == u
                            digit, cells = (place[hit] << width) + digit[hit], len(known) << width
                        n = np.bincount(digit, minlength=cells)
                        sums[at] = sums[at] + n if at in sums else n
            for at, n in sums.items():
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"c": pa.array(np.full(len(some), at, np.int32)), "k": pa.array(some), "n": pa.array(n[some])})
        got = d.select("_g", "_x").mapInArrow(counted, "c int, k long, n long").groupBy("c", "k").agg(F.sum("n").alias("n")).toArrow()
        c, key, n = (got.column(x).to_numpy() for x in ("c", "k", "n"))              # at most 4,096, then 256 rows for each rank
        order = np.lexsort((key, c))
        c, key, n = c[order], key[order], n[order]
        for at in np.unique(c).tolist():
            own = slice(*np.searchsorted(c, [at, at + 1]))
            keys, to = key[own], np.cumsum(n[own])
            start = np.append(0, to[:-1])
            if k == 0:
                exact = (to[-1] - 1) * np.asarray(shares, float)
                low = np.floor(exact).astype(np.int64)
                between[at] = exact - low
                target = np.concatenate([low, np.minimum(low + 1, to[-1] - 1)])
            else:
                place, rest = need[at]
                target = start[np.searchsorted(keys, place << width)] + rest
            found = np.searchsorted(to, target, "right")
            digits = keys[found].astype(np.uint64)
            if k:
                digits = (prefix[at][place] << np.uint64(width)) | (digits & np.uint64((1 << width) - 1))
            prefix[at], place = np.unique(digits, return_inverse=True)
            need[at] = place, target - start[found]
        shared.unpersist()
    out = {}
    for at, (place, _) in need.items():
        low, high = _doubles(prefix[at])[place].reshape(2, -1)
        out[at] = low, high, between[at]
    return out


def stored_medians(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """``by`` (if given: a column of few values) and the exact medians of
    ``cols`` under their names, like :func:`quantiles`, of a frame that is cheap
    to read several times."""
    spark = df.sparkSession
    groups = [None] if by is None else [r[0] for r in df.select(by).where(F.col(by).isNotNull()).distinct().collect()]
    code = F.lit(0) if by is None else F.coalesce(*[F.when(F.col(by) == F.lit(g), F.lit(i)) for i, g in enumerate(groups)], F.lit(-1))
    d = df.select(code.cast("int").alias("_g"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x")).where("_g >= 0")
    found = order_statistics(d, len(cols), [0.5]) if groups and cols else {}

    def median(at: int) -> float | None:
        if at not in found:
            return None
        low, high, rest = (float(x[0]) for x in found[at])
        return low if rest == 0 else (1 - rest) * low + rest * high
    rows = [((g,) if by else ()) + tuple(median(i * len(cols) + f) for f in range(len(cols))) for i, g in enumerate(groups)]
    schema = T.StructType(([df.schema[by]] if by else []) + [T.StructField(c, T.DoubleType()) for c in cols])
    # a local table, whose size Spark knows: rows meet it without a shuffle
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], to_arrow_schema(schema)), schema)
