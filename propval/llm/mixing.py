"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources, by code point and null last, weigh 1, 2, 3, 1, 2, 3, ...  The mix
has as many words as all documents.  A source's target is its share by
weight, at most ``MAX_REPEATS`` times its size; what that cuts off is shared
out again by weight among the others.  Each source is cut into shards of
about ``SHARD_WORDS`` words by a seeded hash, the mix into blocks of
``BLOCK_WORDS`` words, and the blocks go to the shards by the highest
quotients claim / (2k + 1).  A shard orders its documents by seeded hash
and takes its quota as whole passes over itself plus one run of blocks that
begins at a seeded block and wraps around.

Defined results: a null or empty text has size 0 and nothing is taken of
it; null sources are one source, the last; every row counts, so rows that
repeat a doc_id are documents of their own; equal quotients go to the
earlier (source, shard); an empty table gives an empty mix.

The driver holds one number per source (the source list is a catalogue);
documents, shards and quotas stay distributed.  Only built-in functions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propval.llm import textbytes as tb
from propval.llm.store import written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 16
TIED_SEATS = 10_000                       # seats that a sort, not a narrower interval, puts in order
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]]) -> dict[str | None, float]:
    """Each source's target words; ``sizes`` has its words."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, (s, _) in enumerate(order)}
    most = {s: float(MAX_REPEATS * n) for s, n in order}
    left, out, free = float(sum(n for _, n in order)), {}, [s for s, _ in order]
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > most[s]]
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = most[s]
            left -= most[s]
        free = [s for s in free if s not in out]
    return out


def _seats(multiplier: Column | float) -> Column:
    """Blocks of a shard at a multiplier: Sainte-Laguë rounds claims by halves."""
    return F.least(F.floor(F.col("claim") * multiplier + 0.5), F.col("most"))


def apportion(shards: DataFrame, blocks: int) -> DataFrame:
    """shards (source, shard, claim, most) with ``quota``, integers that sum
    to ``blocks`` where ``most`` allows: the blocks go one by one to the
    highest claim / (2k + 1).  The multiplier that parts the quotients which
    get a block from those that don't is found by narrowing an interval;
    each pass counts the seats at many multipliers in one aggregation."""
    def seats(at: list[float]) -> list[tuple[int, int]]:
        """All seats at each multiplier, and the most one shard gains beyond the one before it."""
        row = shards.agg(*[F.coalesce(F.sum(_seats(m)), F.lit(0)) for m in at],
                         *[F.coalesce(F.max(_seats(m) - _seats(l)), F.lit(0)) for l, m in zip([at[0], *at], at, strict=False)]).first()
        return list(zip(map(int, row[:len(at)]), map(int, row[len(at):]), strict=True))

    low, high = 0.0, 2.0 / BLOCK_WORDS
    while seats([high])[0][0] <= blocks:
        if high > 1e9:                                     # every shard is full
            return shards.withColumn("quota", F.col("most"))
        low, high = high, high * 8
    while True:
        at = [low, *sorted({float(m) for m in np.linspace(low, high, 18)[1:-1]} - {low, high}), high]
        found = seats(at)
        i = max(k for k, (n, _) in enumerate(found) if n <= blocks)
        low, high, n, step = at[i], at[i + 1], found[i][0], found[i + 1][1]
        if step <= 1 and found[i + 1][0] - n <= TIED_SEATS or len(at) == 2:
            break
    # The seats between the two multipliers, by quotient, then (source, shard).
    last = (shards.where(_seats(high) > _seats(low))
            .orderBy((F.col("claim") / (2 * _seats(low) + 1)).desc(), F.col("source").asc_nulls_last(), "shard").limit(blocks - n)
            .select(F.col("source").alias("s"), F.col("shard").alias("h"), F.lit(1).alias("more")))
    return (shards.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")), "left")
            .withColumn("quota", (_seats(low) + F.coalesce("more", F.lit(0))).cast("long")).drop("s", "h", "more"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and n_blocks (the
    quota of its shard) of every row of docs."""
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    totals = [(r[0], r[1]) for r in sized.groupBy("source").agg(F.sum("size")).collect()]
    goal, spark = targets(totals), docs.sparkSession
    blocks = math.floor(sum(n for _, n in totals) / BLOCK_WORDS + 0.5)
    sources = spark.createDataFrame([(s, n, goal[s], max(1, -(-n // SHARD_WORDS))) for s, n in totals],
                                    "s string, source_size long, target double, n_shards long")
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    dealt = (sized.join(sources, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
             .withColumn("order", order).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "order"), "n_shards")))
    shards = written(dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("words"), (F.first("target") * F.sum("size") / F.first("source_size")).alias("claim"))
        .where("words > 0").withColumn("most", F.expr(f"{MAX_REPEATS} * words div {BLOCK_WORDS}")))
    quota = apportion(shards, blocks).select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "words", "quota")
    before = Window.partitionBy("source", "shard").orderBy("order", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (dealt.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
              .join(quota, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")), "left")
              .withColumn("n_blocks", F.coalesce("quota", F.lit(0)))
              .withColumn("words", F.greatest(F.coalesce("words", F.lit(0)), F.lit(1)))
              .withColumn("passes", F.expr(f"n_blocks * {BLOCK_WORDS} div words"))
              .withColumn("run", F.col("n_blocks") * BLOCK_WORDS - F.col("passes") * F.col("words"))
              .withColumn("begin", F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"),
                                          F.expr(f"(words + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}")) * BLOCK_WORDS))

    def shared(first: Column, last: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), last) - F.greatest(F.col("start"), first))
    to = F.col("begin") + F.col("run")
    taken = F.col("passes") * F.col("size") + shared(F.col("begin"), F.least(to, F.col("words"))) + shared(F.lit(0), to - F.col("words"))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "n_blocks")


MIXED = ("size", "source_size", "target", "taken", "n_blocks")


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """The rows of docs that the mix takes words of, with their columns (those
    called like one of MIXED go) and MIXED."""
    aside, names, back = tb.set_aside(tb.without(docs, list(MIXED)))
    copy = Window.partitionBy("key").orderBy(F.lit(0))        # rows with equal id and text are alike: any order does
    own = aside.withColumn("key", F.struct(F.col(names[doc_id]).alias("id"), F.xxhash64(names[text]).alias("hash")))
    rows = mix(own, "key", names[source], names[text], seed).withColumnRenamed("doc_id", "key").withColumn("copy", F.row_number().over(copy))
    taken = rows.where("taken > 0").select(F.col("key").alias("k"), F.col("copy").alias("c"), *MIXED)
    return (own.withColumn("copy", F.row_number().over(copy)).join(taken, (F.col("key") == F.col("k")) & (F.col("copy") == F.col("c")))
            .select(*back, *MIXED))
