"""Isolation forest as Spark jobs.

1. Every row draws, per tree, a deterministic hash; rows under a small
   threshold form that tree's candidate sample and the 256 smallest hashes
   are kept (the window runs over a few hundred rows per tree, never a
   whole data group).
2. ``groupBy(tree).applyInPandas`` grows each isolation tree from its 256
   rows (numpy, bounded work) and returns it as a node table.
3. The node tables (trees x at most 511 nodes) are broadcast as complete
   binary trees, in which the children of node i are 2 i + 1 and 2 i + 2, and
   every partition scores its rows vectorised (``mapInPandas``): a level of a
   tree is three look-ups and a comparison for all rows of a batch.
4. The anomaly cut is the exact ``1 - contamination`` percentile of the score.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propval.functions.quantiles import quantile_row
from propval.sources.io import stored

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, size int, depth int")


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow(pdf: pd.DataFrame, features: list[str], max_depth: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    X = pdf[features].to_numpy(dtype=float)
    rng = np.random.default_rng(tree * 7919 + 17)
    rows = []

    def build(idx, depth):
        node = len(rows)
        rows.append(None)
        pts = X[idx]
        if depth >= max_depth or len(idx) <= 1:
            rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx), depth)
            return node
        spread = pts.max(axis=0) - pts.min(axis=0)
        cand = np.flatnonzero(spread > 0)
        if cand.size == 0:
            rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx), depth)
            return node
        f = int(rng.choice(cand))
        t = float(rng.uniform(pts[:, f].min(), pts[:, f].max()))
        left = idx[pts[:, f] < t]
        right = idx[pts[:, f] >= t]
        li = build(left, depth + 1)
        ri = build(right, depth + 1)
        rows[node] = (tree, node, f, t, li, ri, len(idx), depth)
        return node

    build(np.arange(len(X)), 0)
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])


def _laid_out(tree: pd.DataFrame, max_depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree's node table as a complete binary tree: feature and threshold
    by inner place, and path length by place of the last level.  What is below
    a leaf has the leaf's path length, whichever way a row goes."""
    feature, threshold = np.zeros(2 ** max_depth - 1, dtype=np.intp), np.zeros(2 ** max_depth - 1)
    path = np.zeros(2 ** max_depth)
    nodes = {n: (f, t, li, ri, s, d) for n, f, t, li, ri, s, d in
             tree[["node", "feature", "threshold", "left", "right", "size", "depth"]].itertuples(index=False)}
    todo = [(0, 0, 0)]
    while todo:
        node, place, level = todo.pop()
        f, t, li, ri, size, depth = nodes[node]
        if f < 0:
            width = 2 ** (max_depth - level)
            first = (place + 1) * width - 2 ** max_depth
            path[first:first + width] = depth + _c(size)
        else:
            feature[place], threshold[place] = f, t
            todo += [(li, 2 * place + 1, level + 1), (ri, 2 * place + 2, level + 1)]
    return feature, threshold, path


def _total_path(X: np.ndarray, forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]], max_depth: int) -> np.ndarray:
    """Sum of the path lengths of the rows of X (rows x features) over the trees."""
    n = len(X)
    flat, rows = np.ascontiguousarray(X.T).reshape(-1), np.arange(n)
    total = np.zeros(n)
    at, value, place = np.empty(n, dtype=np.intp), np.empty(n), np.empty(n, dtype=np.intp)
    cut, left = np.empty(n), np.empty(n, dtype=bool)
    for feature, threshold, path in forest:
        start = feature * n
        place.fill(0)
        for _ in range(max_depth):
            # mode: nothing is out of range, and only "raise" copies what it takes
            np.take(start, place, out=at, mode="clip")
            np.add(at, rows, out=at)
            np.take(flat, at, out=value, mode="clip")
            np.take(threshold, place, out=cut, mode="clip")
            np.less(value, cut, out=left)
            np.multiply(place, 2, out=place)
            np.add(place, 2, out=place)
            np.subtract(place, left, out=place)
        np.subtract(place, 2 ** max_depth - 1, out=place)
        total += np.take(path, place, out=value, mode="clip")
    return total


def isolation_forest(df: DataFrame, features: list[str], id_col: str, n_trees: int = 100,
                     sample_size: int = 256, contamination: float = 0.05, seed: int = 42) -> DataFrame:
    """``(id, anomaly_score, is_outlier)``; NULL features are filled with medians."""
    from propval.operators.features import fill_medians, medians_of_stored
    read = stored(df.select(id_col, *features), "forest-rows")              # read for medians, count, samples and scores
    d = fill_medians(read, medians_of_stored(read, features))
    d = d.select(id_col, *[F.col(f).cast("double").alias(f) for f in features])
    n = read.count()
    if n == 0:
        return df.sparkSession.createDataFrame([], f"{id_col} long, anomaly_score double, is_outlier boolean")
    # candidate rate: about 4x the sample per tree, so the 256 kept are a uniform draw
    rate = min(1.0, 4.0 * sample_size / n)
    # a row per tree is filtered in generated code; a filter of the array of trees would be interpreted
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree")
    hashed = F.abs(F.xxhash64(F.col(id_col), F.col("tree"), F.lit(seed)))
    cand = d.select("*", trees).filter((hashed % 1000000007) / 1000000007.0 < rate).withColumn("_h", hashed)
    from pyspark.sql import Window
    w = Window.partitionBy("tree").orderBy("_h", id_col)
    sample = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= sample_size)
    max_depth = int(np.ceil(np.log2(max(sample_size, 2))))
    nodes = (sample.select("tree", *features)
                   .groupBy("tree").applyInPandas(lambda p: _grow(p, features, max_depth), NODE_SCHEMA)
                   .collect())                      # n_trees x (2 * sample_size - 1) rows at most
    table = pd.DataFrame([r.asDict() for r in nodes]).sort_values(["tree", "node"])
    bc = df.sparkSession.sparkContext.broadcast([_laid_out(g, max_depth) for _, g in table.groupby("tree")])
    c_n = _c(sample_size)

    def score(it):
        forest = bc.value
        for pdf in it:
            path = _total_path(pdf[features].to_numpy(dtype=float), forest, max_depth) / max(len(forest), 1)
            yield pd.DataFrame({id_col: pdf[id_col], "anomaly_score": np.power(2.0, -path / c_n)})

    scored = stored(d.mapInPandas(score, f"{id_col} long, anomaly_score double"), "forest-scores")         # read for the cut and the result
    cut = quantile_row(scored, {"c": ("anomaly_score", 1 - contamination)})["c"]
    return scored.withColumn("is_outlier", F.col("anomaly_score") > F.lit(cut))
