"""Hard negatives from an R-tree of embeddings.

Vectors are integers, a row's score is its inner product with the anchor;
higher scores come first, ties by smaller id (null ids last).  For every
anchor and each of its first ``k`` rows of the same label (its positives), the
negatives are the first ``k`` rows of another label whose score lies between
``low`` % and 100 % of the positive's.

The tree is packed by sort, tile and recursion: rows are range-partitioned by
label and the coordinate of most variance (by id where these are equal, so no
value is too frequent for a slab), a task cuts its slab into tiles by the next
two coordinates, and every tile is a leaf row with its vectors and its minimum
bounding box.  ``FAN`` leaves in a row make an inner node.

A box gives an interval for each coordinate's part of the inner product, whose
sum is an interval for all its rows.  For every anchor a queue hands out boxes
by the upper end of theirs, best first; a box is left out if its interval lies
outside all score windows of the anchor or strictly below the k-th score that
each of them has so far, or if its labels can't match.  A task keeps the
anchors' windows from slab to slab; the first k of all tasks are merged by a
rank in groups of k rows a task.

Anchors are the query set.  They go in blocks of about ``BLOCK``, each
broadcast to two passes over the leaves (positives, then negatives).

Scores are exact: in doubles while no product can pass 2^53, else in 64-bit
integers, else in Python's; a score beyond 64 bits is an error, and so is a
component beyond 32 bits.

Defined results: rows with a null label, a null vector or a null or
non-finite component take no part; a shorter vector ends in zeros; rows with
equal ids are different rows; an anchor without positives, or a window
without rows, gives none; an empty table gives none.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propval.llm.store import appended, written

SLAB = 4096                                # rows of a slab, about
LEAF_VALUES = 1 << 13                      # components in a leaf row: 10,000 leaves of an Arrow batch stay below 400 MB
FAN = 16
BLOCK = 4096                               # anchors that are broadcast at once, about
NO_ID = np.iinfo(np.int64).max             # stands for a null id, so it comes last
EXACT = 2.0 ** 53


def usable(vec: str, label: str) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(label).isNotNull() & F.col(vec).isNotNull() & ~bad


def scaled(vec: str, by: int) -> Column:
    """floor(by * x) of every component."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * by))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width``, the shorter ones ending in zeros."""
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(np.arange(len(n)), n), at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def axes(rows: DataFrame, width: int, most: int = 3) -> list[int]:
    """The coordinates of most variance, at least one."""
    def run(batches):
        n, s, ss = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            m = _matrix(batch.column("v"), width).astype(float)
            n, s, ss = n + len(m), s + m.sum(axis=0), ss + (m * m).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(s), pa.array(ss)], names=["axis", "n", "s", "ss"])
    sums = rows.select("v").mapInArrow(run, "axis long, n long, s double, ss double").groupBy("axis").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    spread = F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)
    return [r.axis for r in sums.orderBy(F.desc(spread), "axis").limit(most).collect()] or [0]


def tiles(label: np.ndarray, v: np.ndarray, along: list[int], size: int) -> list[np.ndarray]:
    """Row numbers of the leaves: each label's rows in slices of equal size by
    one coordinate, those by the next one, down to ``size`` rows."""
    def cut(at: np.ndarray, along: list[int]) -> list[np.ndarray]:
        leaves = math.ceil(len(at) / size)
        if leaves <= 1 or not along:
            return [at[i:i + size] for i in range(0, len(at), size)]
        at = at[np.argsort(v[at, along[0]], kind="stable")]
        step = size * math.ceil(leaves / math.ceil(leaves ** (1 / len(along)) - 1e-9))
        return [leaf for i in range(0, len(at), step) for leaf in cut(at[i:i + step], along[1:])]
    return [leaf for one in np.unique(label) for leaf in cut(np.flatnonzero(label == one), along)]


LEAVES = "slab int, leaf int, label int, rows int, ids binary, rids binary, low binary, high binary, vectors binary"


def leaves(rows: DataFrame, width: int) -> DataFrame:
    """The leaf rows of the tree over rows (rid, id, label, v)."""
    along = axes(rows, width)
    size = max(1, LEAF_VALUES // max(width, 1))

    def run(batches):
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        slab = pa.Table.from_batches(held).combine_chunks()
        v = np.concatenate([_matrix(c, width) for c in slab.column("v").chunks])
        if np.abs(v).max(initial=0) >= 1 << 31:
            raise OverflowError("a component is beyond 32 bits")
        label, rid = slab.column("label").to_numpy(), slab.column("rid").to_numpy()
        ids = slab.column("id").fill_null(NO_ID).to_numpy()
        for k, at in enumerate(tiles(label, v, along[1:] or along, size)):
            yield pa.RecordBatch.from_pydict({
                "slab": pa.array([TaskContext.get().partitionId()], pa.int32()), "leaf": pa.array([k], pa.int32()),
                "label": pa.array([label[at[0]]], pa.int32()), "rows": pa.array([len(at)], pa.int32()),
                "ids": pa.array([ids[at].tobytes()], pa.binary()), "rids": pa.array([rid[at].tobytes()], pa.binary()),
                "low": pa.array([v[at].min(axis=0).astype(np.int32).tobytes()], pa.binary()),
                "high": pa.array([v[at].max(axis=0).astype(np.int32).tobytes()], pa.binary()),
                "vectors": pa.array([v[at].astype(np.int32).tobytes()], pa.binary())})
    slabs = max(1, math.ceil(rows.count() / SLAB))
    first = F.coalesce(F.get("v", F.lit(along[0])), F.lit(0))
    return written(rows.repartitionByRange(slabs, "label", first, "id", "rid").mapInArrow(run, LEAVES))


def _sum_of_products(m: np.ndarray, q: np.ndarray) -> np.ndarray:
    """m @ q of integers, exactly."""
    most = m.shape[1] * float(np.abs(m).max(initial=0)) * float(np.abs(q).max(initial=0))
    if most < EXACT:
        return (m.astype(float) @ q.astype(float)).astype(np.int64)
    if most < 2.0 ** 62:
        return m.astype(np.int64) @ q.astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in m], object).astype(np.int64)


class Boxes:
    """Boxes and what they bound the inner products of many vectors by."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low.astype(float), high.astype(float)

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) ends of the inner products with each row of q, a
        column for each box; no bound where doubles aren't exact."""
        up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
        lower, upper = up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T
        most = q.shape[1] * np.abs(q).max(initial=0) * float(max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0)))
        if most >= EXACT:
            lower[:], upper[:] = -np.inf, np.inf
        return lower, upper


class Tree:
    """The tree of a slab: its leaves, and nodes of FAN leaves."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.label = batch.column("label").to_numpy()
        get = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in batch.column(name)]
        self.ids, self.rids = get("ids", np.int64), get("rids", np.int64)
        self.vectors = [x.reshape(-1, width) for x in get("vectors", np.int32)]
        low, high = np.stack(get("low", np.int32)), np.stack(get("high", np.int32))
        at = np.arange(0, len(low), FAN)
        self.leaves, self.nodes = Boxes(low, high), Boxes(np.minimum.reduceat(low, at), np.maximum.reduceat(high, at))
        self.least, self.most = np.minimum.reduceat(self.label, at), np.maximum.reduceat(self.label, at)

    def may_match(self, label: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes and which leaves can hold rows of the label, or of others."""
        if same:
            return (self.least <= label) & (label <= self.most), self.label == label
        return (self.least != label) | (self.most != label), self.label != label


@dataclass
class ScoreWindow:
    """The first k rows so far whose score is from low to high."""
    low: float
    high: float
    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def least(self) -> float:
        """A row needs this score: its id may decide where it is the k-th's."""
        return max(self.low, self.score[-1]) if len(self.score) == self.k else self.low

    def add(self, score: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        fits = np.flatnonzero((score >= self.least) & (score <= self.high))
        if len(fits):
            score, ids, rids = (np.concatenate([a, b[fits]]) for a, b in ((self.score, score), (self.ids, ids), (self.rids, rids)))
            first = np.lexsort((rids, ids, -score))[:self.k]
            self.score, self.ids, self.rids = score[first], ids[first], rids[first]


@dataclass
class Anchor:
    rid: int
    label: int
    vector: np.ndarray
    windows: list[ScoreWindow]


def search(tree: Tree, anchors: list[Anchor], same: bool) -> int:
    """Adds the tree's rows to the windows of the anchors, best boxes first;
    returns how many leaves were read."""
    q = np.stack([a.vector for a in anchors])
    (node_low, node_up), (leaf_low, leaf_up) = tree.nodes.intervals(q), tree.leaves.intervals(q)
    read = 0
    for i, anchor in enumerate(anchors):
        nodes, leaf_ok = tree.may_match(anchor.label, same)

        def wanted(lower, upper, windows=anchor.windows):
            return any(upper >= w.least and lower <= w.high for w in windows)
        queue = [(-node_up[i, k], 0, int(k)) for k in np.flatnonzero(nodes)]
        heapq.heapify(queue)
        while queue:
            upper, is_leaf, k = heapq.heappop(queue)
            if not is_leaf:
                if wanted(node_low[i, k], -upper):
                    for leaf in range(k * FAN, min((k + 1) * FAN, len(tree.label))):
                        if leaf_ok[leaf] and wanted(leaf_low[i, leaf], leaf_up[i, leaf]):
                            heapq.heappush(queue, (-leaf_up[i, leaf], 1, leaf))
            elif wanted(leaf_low[i, k], -upper):
                read += 1
                score = _sum_of_products(tree.vectors[k], anchor.vector)
                ids, rids = tree.ids[k], tree.rids[k]
                if same:
                    other = rids != anchor.rid
                    score, ids, rids = score[other], ids[other], rids[other]
                for w in anchor.windows:
                    w.add(score, ids, rids)
    return read


FOUND = "anchor long, high long, rid long, id long, score long"


def pass_over(tree_leaves: DataFrame, anchors: list[Anchor], same: bool, k: int, width: int) -> DataFrame:
    """(anchor, high, rid, id, score, rank): the first k rows of every window."""
    spark = tree_leaves.sparkSession
    shared = spark.sparkContext.broadcast(anchors)

    def run(batches):
        asked = [Anchor(a.rid, a.label, a.vector, [ScoreWindow(w.low, w.high, w.k) for w in a.windows]) for a in shared.value]    # of this task alone
        slab, held = None, []

        def done():
            search(Tree(pa.Table.from_batches(held).combine_chunks().to_batches()[0], width), asked, same)
        for batch in batches:
            numbers = batch.column("slab").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(numbers)]])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a < b:
                    if held and numbers[a] != slab:
                        done()
                        held = []
                    slab = numbers[a]
                    held.append(batch.slice(a, b - a))
        if held:
            done()
        for a in asked:
            for w in a.windows:
                if len(w.score):
                    n = len(w.score)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, a.rid)), pa.array(np.full(n, int(min(w.high, NO_ID)))), pa.array(w.rids),
                                                      pa.array(w.ids), pa.array(w.score)], names=["anchor", "high", "rid", "id", "score"])
    tasks = 4 * spark.sparkContext.defaultParallelism
    found = tree_leaves.repartition(tasks, "slab").sortWithinPartitions("slab", "leaf").mapInArrow(run, FOUND)
    order = Window.partitionBy("anchor", "high").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor: Column, k: int = 5, low: int = 80) -> DataFrame:
    """rows: id long, label int, v array of long.  anchor_id, positive_id, rank,
    negative_id, positive_score and negative_score of all anchors."""
    spark = rows.sparkSession
    rows = written(rows.select(F.monotonically_increasing_id().alias("rid"), F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"),
                               "v", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")))
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    anchors = rows.where("is_anchor").select("rid", "id", "label", "v")
    blocks = math.ceil(anchors.count() / BLOCK)
    tree = leaves(rows.drop("is_anchor"), width) if blocks else None

    def of_block(b: int) -> DataFrame:
        asked = anchors.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == b).toArrow().combine_chunks()
        vectors = np.concatenate([_matrix(c, width) for c in asked.column("v").chunks] or [np.zeros((0, width), np.int64)])
        named = dict(zip(asked.column("rid").to_pylist(), asked.column("id").to_pylist(), strict=True))
        made = [Anchor(r, lab, v, [ScoreWindow(-np.inf, np.inf, k)]) for r, lab, v in zip(named, asked.column("label").to_pylist(), vectors, strict=True)]
        positives: dict[int, list[tuple[int, int]]] = {}
        for r in pass_over(tree, made, True, k, width).select("anchor", "id", "score").collect() if made else []:      # k rows an anchor
            positives.setdefault(r.anchor, []).append((r.id, r.score))
        for a in made:
            a.windows = [ScoreWindow(-((-low * s) // 100), s, k) for s in sorted({s for _, s in positives.get(a.rid, []) if s >= 0})]
        pairs = spark.createDataFrame([(a, named[a], p, s) for a, own in positives.items() for p, s in own], "anchor long, anchor_id long, positive_id long, high long")
        found = pass_over(tree, [a for a in made if a.windows], False, k, width) if any(a.windows for a in made) else spark.createDataFrame([], FOUND + ", rank int")
        null = lambda c: F.nullif(F.col(c), F.lit(int(NO_ID)))
        return found.join(pairs, ["anchor", "high"]).select(
            "anchor_id", null("positive_id").alias("positive_id"), "rank", null("id").alias("negative_id"), F.col("high").alias("positive_score"),
            F.col("score").alias("negative_score"))
    return appended(spark, (of_block(b) for b in range(blocks)), RESULT)


def hard_negatives(df: DataFrame, record_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """The negatives of the rows whose id is divisible by 100; rows whose id is
    divisible by 7 have the next label of ten, components are floor(256 x)."""
    own = F.col(record_id)
    moved = F.when(own % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
    rows = df.where(usable(vec, label)).select(own.alias("id"), moved.alias("label"), scaled(vec, 256).alias("v"))
    return mine(rows, F.col("id") % 100 == 0)


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
