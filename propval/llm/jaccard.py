"""Exact Jaccard join in metric space.

Documents are sets of distinct 3-word shingles; two link when 100 * shared
>= 90 * all, a Jaccard distance of at most r = 0.1.  The join finds the
connected components of all links:

1. *Classes.*  Equal sets are one class; the rest works on classes.
2. *Regions.*  In the metric of differing shingles, two sets that link differ
   in at most (n + m) / 19 shingles.  The first pivot is the empty set: it
   parts the sets by size into bands, and by the triangle inequality a set
   links only into the next band if its size is within a tenth of the edge;
   it is replicated there.  In a band with at most D differing shingles the
   hash space is cut into D + 1 slices.  The differences can't touch every
   slice, so linked sets agree on one: each part of a set in a slice is a
   pivot at distance 0, and its region are the sets with that very part.
   (Whole documents as first pivots can't part a corpus: unrelated documents
   are all at distance 1 of every pivot, so each would go to every region.)
   A class without another of a size within a tenth is done in a region, and
   regions with equal members are one.
3. *Recursion.*  In a region, classes are compared by the counts of their
   shingles in 64 hash ranges.  The weighted Jaccard distance of the counts is
   a metric and never more than the distance of the sets.  A region of more
   than ``LEAF`` classes takes classes of its own as pivots: each class goes
   to the Voronoi cell of its nearest pivot and to every cell whose pivot is
   at most 2 r farther (triangle inequality), and cells split again.  A region
   that pivots don't part is joined block by block.
4. *Links.*  In small regions the class nearest to the median of the counts
   is compared with the others, then the same among those not near it; sets
   decide.  Then every class of a region that still holds several components
   is compared with the nearest of another, as long as that finds links, and
   at last all pairs across components that the distance allows.  So no link
   between components is missed, and no group emits all its pairs.

Defined results: a null or empty text has an empty set, is linked with
nothing and is its own component; null ids link like others, and a component
of null ids has a null id; rows that repeat a doc_id are documents of their
own; an empty table gives an empty result.  Shingles and sets are told apart
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.llm import textbytes as tb
from propval.llm.components import components
from propval.llm.store import written

SHINGLE = 3
RADIUS = 0.1
RANGES = 64              # hash ranges of the counts
LEAF = 2048              # classes of a region that one task compares
PIVOTS = 16
CARRY = 200_000          # classes of a region whose members are compared with other regions'


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes by text, ascending in each: (text number,
    hash), and of every text the number of them and its set's hash."""
    data, offsets = tb.text_bytes(texts)
    docs = len(offsets) - 1
    start, end, owner = tb.words(data, offsets)
    word = tb.SpanHash(data, lower=True)(start, end)
    at, key = tb.windows(word, owner, SHINGLE)
    owners, keys = [owner[at]], [key]
    n_words = np.bincount(owner, minlength=docs)
    for n in range(1, SHINGLE):                     # shorter texts: the whole sequence
        at, key = tb.windows(word, owner, n)
        short = n_words[owner[at]] == n
        owners.append(owner[at][short])
        keys.append(key[short])
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(key)
    order = order[np.argsort(owner[order].astype(np.uint16 if docs < 1 << 16 else np.int64), kind="stable")]
    owner, key = owner[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    owner, key = owner[new], key[new]
    n = np.bincount(owner, minlength=docs).astype(np.int64)
    run = np.concatenate([[tb.U(0)], np.cumsum(tb.mix(key ^ tb.BASE))])
    to = np.cumsum(n)
    return owner, key, n, tb.mix(run[to] - run[to - n] + n.astype(tb.U)).view(np.int64)


MEMBER = [T.StructField("n_shingles", T.LongType()), T.StructField("class", T.LongType())]


def members(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_shingles and class, the hash of its set (null if empty)."""
    def of(texts):
        _, _, n, cls = shingles(texts)
        return [pa.array(n), pa.array(cls, mask=n == 0)]
    return tb.append_columns(df, text, MEMBER, of)


#: Lower edges of the size bands.
EDGES = np.unique(np.ceil(2.0 ** (np.arange(80) / 2)).astype(np.int64))


def _parts(n: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Slices in which sets of the band can't all differ."""
    return 2 * (EDGES[band + 1] - 1) // 19 + 1


def slice_regions(owner: np.ndarray, key: np.ndarray, n: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set number, region) of sets in a band each: a region for every part
    of the set in a slice.  A part without shingles counts only where the
    others are too few to hold a part without difference."""
    m = _parts(n, band)
    piece = ((key >> tb.U(32)) * m.astype(tb.U)[owner]) >> tb.U(32)
    first = np.ones(len(key), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
    at = np.flatnonzero(first)
    run = np.concatenate([[tb.U(0)], np.cumsum(tb.mix(key + tb.BASE))])
    name = (band.astype(tb.U)[owner[at]] << tb.U(40)) + piece[at]
    region = tb.mix((run[np.append(at[1:], len(key))] - run[at]) ^ tb.mix(name))
    own = owner[at]
    filled = np.bincount(own, minlength=len(n))
    owners, regions = [own], [region]
    for i in np.flatnonzero((filled < m) & (n > 0)):
        if filled[i] <= m[i] - 1:                              # at most D parts: an empty one may be the one that agrees
            free = np.setdiff1d(np.arange(m[i]), piece[at][own == i].astype(np.int64)).astype(tb.U)
            owners.append(np.full(len(free), i))
            regions.append(tb.mix(tb.mix((tb.U(int(band[i])) << tb.U(40)) + free) + tb.U(1)))
    return np.concatenate(owners), np.concatenate(regions)


PARTS = "part long, class long, n long"


def _band_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, class, n): the regions of each class in its band, and in the
    next one if its size is within a tenth of that."""
    for part in tb.slices(batches, "text"):
        owner, key, n, cls = shingles(part.column("text"))
        once = np.zeros(len(cls), bool)
        once[np.unique(cls, return_index=True)[1]] = True          # copies have one region
        band = np.searchsorted(EDGES, np.maximum(n, 1), "right") - 1
        for up in (0, 1):
            use = once & (n > 0) & (_parts(n, band + up) > 1)      # one part: only copies link
            if up:
                use &= 10 * n >= 9 * EDGES[band + 1]
            if use.any():
                keep = use[owner]
                number = np.cumsum(use) - 1
                who, region = slice_regions(number[owner[keep]], key[keep], n[use], band[use] + up)
                yield pa.RecordBatch.from_arrays([pa.array(region.view(np.int64)), pa.array(cls[use][who]), pa.array(n[use][who])], names=["part", "class", "n"])


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (part, class, n) sorted by part and class: the regions with
    two classes or more, called by a hash of their members.  A region is held
    until it ends; one of more than CARRY classes goes out under its own name."""
    names = ["region", "class", "n"]
    held = None              # rows of the last region so far
    large = None             # the name of a region that was too long to hold

    def out(part, cls, n, name=None):
        once = np.ones(len(cls), bool)
        once[1:] = (part[1:] != part[:-1]) | (cls[1:] != cls[:-1])
        part, cls, n = part[once], cls[once], n[once]
        order = np.lexsort((cls, n, part))
        part, cls, n = part[order], cls[order], n[order]
        near = np.zeros(len(cls) + 1, bool)                        # to the one before in size
        near[1:-1] = (part[1:] == part[:-1]) & (10 * n[:-1] >= 9 * n[1:])
        useful = near[1:] | near[:-1] if name is None else np.ones(len(cls), bool)
        part, cls, n = part[useful], cls[useful], n[useful]
        first = np.ones(len(cls), bool)
        first[1:] = part[1:] != part[:-1]
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(cls)))
        if name is None:
            run = np.concatenate([[tb.U(0)], np.cumsum(tb.mix(cls.view(tb.U)))])
            region = np.repeat(tb.mix(run[begin + size] - run[begin] + size.astype(tb.U)).view(np.int64), size) if len(cls) else cls
        else:
            region = np.full(len(cls), name)
        return pa.RecordBatch.from_arrays([pa.array(region), pa.array(cls), pa.array(n)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in ("part", "class", "n")]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        if large is not None:
            to = int(np.searchsorted(rows[0] != large, True))
            yield out(*(x[:to] for x in rows), name=large)
            rows = [x[to:] for x in rows]
            if not len(rows[0]):
                held = None
                continue
            large = None
        to = int(np.searchsorted(rows[0] == rows[0][-1], True))    # the last region may go on
        yield out(*(x[:to] for x in rows))
        held = [x[to:] for x in rows]
        if len(held[0]) > CARRY:
            large = held[0][0]
            yield out(*held, name=large)
            held = None
    if held is not None and len(held[0]):
        yield out(*held)


SETS = "class long, n long, counts binary, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of the rows, each class once a task."""
    seen: set[int] = set()
    for part in tb.slices(batches, "text"):
        owner, key, n, cls = shingles(part.column("text"))
        counts = np.zeros((len(n), RANGES), np.uint32)
        np.add.at(counts, (owner, (key >> tb.U(58)).astype(np.int64)), 1)
        to = np.cumsum(n)
        full = np.flatnonzero((n > 0) & (cls == part.column("wanted").to_numpy()))
        full = np.array([i for i in full[np.unique(cls[full], return_index=True)[1]] if int(cls[i]) not in seen], np.int64)
        seen.update(cls[full].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(cls[full]), pa.array(n[full]), pa.array([counts[i].tobytes() for i in full], pa.binary()),
                                          pa.array([key[to[i] - n[i]:to[i]].tobytes() for i in full], pa.binary())],
                                         names=["class", "n", "counts", "shingles"])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weighted Jaccard distances of the rows of counts x to those of y."""
    out = np.empty((len(x), len(y)), np.float32)
    step = max(1, 4_000_000 // max(1, len(y) * RANGES))
    total = y.sum(axis=1, dtype=np.int64)
    for i in range(0, len(x), step):
        a = x[i:i + step]
        low = np.minimum(a[:, None, :], y[None, :, :]).sum(axis=2, dtype=np.int64)
        out[i:i + step] = 1 - low / np.maximum(a.sum(axis=1, dtype=np.int64)[:, None] + total[None, :] - low, 1)
    return out


_SLACK = 1e-5            # float error of a distance


def _counts(column: pa.Array) -> np.ndarray:
    return tb.text_bytes(column)[0].view(np.uint32).reshape(-1, RANGES)


def _star(cls: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Pairs of the most central class with those near it, then the same
    among the others."""
    out, left = [], np.arange(len(cls))
    while len(left) > 1:
        own = counts[left]
        centre = int(_distances(np.median(own, axis=0)[None].astype(np.uint32), own)[0].argmin())
        near = _distances(own[centre:centre + 1], own)[0] <= RADIUS + _SLACK
        near[centre] = False
        out.append(np.stack([np.full(near.sum(), cls[left[centre]]), cls[left[near]]]))
        near[centre] = True
        left = left[~near]
    return out


def _across(cls: np.ndarray, n: np.ndarray, counts: np.ndarray, component: np.ndarray, nearest: bool) -> list[np.ndarray]:
    """Near pairs of different components: all, or the nearest of each class."""
    out = []
    for i in range(0, len(cls), 256):
        to = int(np.searchsorted(n, n[min(i + 256, len(n)) - 1] * 10 // 9, "right"))       # sizes within 9 / 10
        d = _distances(counts[i:i + 256], counts[i:to])
        d[(component[i:i + 256, None] == component[None, i:to]) | (d > RADIUS + _SLACK)] = np.inf
        d[np.tril_indices(*d.shape[:1], m=d.shape[1])] = np.inf                            # each pair once
        x, y = (np.arange(len(d)), d.argmin(axis=1)) if nearest else np.nonzero(np.isfinite(d))
        ok = np.isfinite(d[x, y]) if d.shape[1] else np.zeros(0, bool)
        out.append(np.stack([cls[i + x[ok]], cls[i + y[ok]]]))
    return out


def _pairs(regions: DataFrame, how: str) -> DataFrame:
    """Candidate pairs (a, b) of regions (region, class, n, counts[,
    component]): how is star, nearest or all."""
    def one(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        cls, n, counts = rows["class"].to_numpy(), rows["n"].to_numpy(), _counts(rows["counts"])
        order = np.lexsort((cls, n))
        cls, n, counts = cls[order], n[order], counts[order]
        if how == "star":
            found = _star(cls, counts)
        else:
            found = _across(cls, n, counts, rows["component"].to_numpy()[order], how == "nearest")
        a, b = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return regions.groupBy("region").applyInArrow(one, "a long, b long").distinct()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [tb.text_bytes(batch.column(c)) for c in ("x", "y")]
        x, y = (d.view(tb.U) for d, _ in sets)
        xo, yo = (o // 8 for _, o in sets)
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            p, q = x[xo[i]:xo[i + 1]], y[yo[i]:yo[i + 1]]
            if len(p) > len(q):
                p, q = q, p
            if 10 * len(p) >= 9 * len(q):
                shared = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                keep[i] = 10 * shared >= 9 * (len(p) + len(q) - shared)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are within the radius."""
    x = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long")


def split(regions: DataFrame) -> DataFrame:
    """regions (region, class, n, counts) parted until each has at most LEAF
    classes: Voronoi cells with replicated windows, or pairs of blocks where
    the pivots don't part a region."""
    done, level = None, 0
    while True:
        sizes = regions.groupBy("region").agg(F.count("*").alias("size")).where(F.col("size") > LEAF)
        if sizes.isEmpty():
            return regions if done is None else done.unionByName(regions)
        level += 1
        sized = regions.join(sizes, "region", "left")
        small = sized.where("size is null").drop("size")
        done = small if done is None else done.unionByName(small)
        big = sized.where("size is not null")
        pick = Window.partitionBy("region").orderBy(F.xxhash64(F.lit(level), "class"), "class")
        pivots = (big.withColumn("i", F.row_number().over(pick)).where(F.col("i") <= PIVOTS).groupBy("region")
                  .agg(F.array_sort(F.collect_list(F.struct("i", "counts"))).alias("pivots")))

        def cells(batches, level=level):
            for batch in batches:
                if not batch.num_rows:
                    continue
                region, counts = batch.column("region").to_numpy(), _counts(batch.column("counts"))
                rows, new = [], []
                for r in np.unique(region):
                    own = np.flatnonzero(region == r)
                    centre = _counts(pa.array([p["counts"] for p in batch.column("pivots")[int(own[0])].as_py()], pa.binary()))
                    d = _distances(counts[own], centre)
                    into = d <= d.min(axis=1, keepdims=True) + 2 * RADIUS + _SLACK
                    i, j = np.nonzero(into)
                    rows.append(own[i])
                    new.append(tb.mix(np.full(len(i), r).view(tb.U) * tb.BASE + (j + 1 + 64 * level).astype(tb.U)).view(np.int64))
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(new)), *(batch.column(c).take(take) for c in ("class", "n", "counts", "size")),
                                                  batch.column("region").take(take)], names=["region", "class", "n", "counts", "size", "parent"])
        fields = "region long, class long, n long, counts binary, size long, parent long"
        parted = written(big.join(pivots, "region").mapInArrow(cells, fields))
        flat = (parted.groupBy("parent", "region").agg(F.count("*").alias("k"), F.first("size").alias("size"))
                .where(F.col("k") * 10 > F.col("size") * 8).select("parent").distinct())
        ways = F.ceil(F.col("size") / (LEAF // 2)).cast("int")
        block = F.pmod(F.xxhash64("class"), ways.cast("long"))
        other = F.explode(F.sequence(F.lit(0), ways - 1))
        blocks = (big.join(flat.withColumnRenamed("parent", "region"), "region", "left_semi").withColumn("block", block).withColumn("other", other)
                  .select(F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "class", "n", "counts"))
        done = done.unionByName(blocks)
        regions = parted.join(flat, "parent", "left_anti").select("region", "class", "n", "counts")


def link_table(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, n_shingles, class; components: node, component),
    both by class; classes that link with none aren't in components."""
    named = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    docs = written(members(named).drop("text"))
    parts = named.select("text").mapInArrow(_band_parts, PARTS).repartition("part").sortWithinPartitions("part", "class")
    regions = written(parts.mapInArrow(_regions, "region long, class long, n long").dropDuplicates(["region", "class"]))
    one_of = (docs.join(regions.select("class").distinct(), "class").groupBy(F.col("class").alias("wanted")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k"))
              .select("wanted", F.col("k.doc_id").alias("id"), F.col("k.text_hash").alias("hash")))
    # The hash tells rows of one id, or of none, apart; copies of one row meet in one task.
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    sets = written(named.join(one_of.hint("shuffle_hash"), same).select("wanted", "text").mapInArrow(_sets, SETS))
    parts = written(split(regions.join(sets.select("class", "counts"), "class").select("region", "class", "n", "counts")))
    links = written(_links(_pairs(parts, "star"), sets))
    found = components(links)
    for how in ("nearest", "all"):
        while True:
            labelled = parts.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
            several = labelled.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("region")
            more = written(_links(_pairs(labelled.join(several, "region", "left_semi"), how), sets))
            if more.isEmpty():
                break
            links = links.unionByName(more)
            found = components(links)
            if how == "all":                                   # every pair that may link has been compared
                break
    return docs.drop("text_hash"), found


def join(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable), class
    and component (the class that names it; null without a set)."""
    docs, found = link_table(df, doc_id, text)
    labelled = (docs.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class")))
    smallest = labelled.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return labelled.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        "class", "component")


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with one row of each component, that of the smallest doc_id, in its
    own columns; rows with an empty set stay."""
    joined = written(join(df, doc_id, text))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "class")
    keep = (joined.where("component is not null").groupBy("component").agg(F.min(order).alias("k"))
            .select(F.col("k.doc_id").alias("_keep_id"), F.col("k.class").alias("_keep_class")))
    aside, names, back = tb.set_aside(df)
    marked, own_id = members(aside, names[text]), names[doc_id]
    kept = (marked.where("class is not null").join(keep, F.col(own_id).eqNullSafe(F.col("_keep_id")) & (F.col("class") == F.col("_keep_class")))
            .dropDuplicates([own_id, "class"]))
    return kept.select(back).unionByName(marked.where("class is null").select(back))
