"""Image tags: parse, count, canonicalise, one-hot, pairs and triples.

The image analysis arrives as Python-dict text per property.  It is turned
into a typed map with ``from_json`` (after rewriting the Python literals),
so parsing stays inside the JVM.  Counting works on the long form
``(property_id, tag)`` with map-side partial aggregation; vocabularies are
top-N tables (size bounded by N) that are broadcast to the wide steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.sources.io import stored

IMAGE_SCHEMA = T.MapType(T.StringType(), T.StructType([
    T.StructField("prominent_features", T.ArrayType(T.StringType())),
    T.StructField("image_type", T.StringType()),
    T.StructField("granular_condition_num", T.DoubleType()),
    T.StructField("high_condition_num", T.DoubleType()),
]))

JSON_OPTIONS = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true",
                "allowBackslashEscapingAnyCharacter": "true", "allowNonNumericNumbers": "true",
                "mode": "PERMISSIVE"}


def python_literals_to_json(text: Column) -> Column:
    """Rewrite ``None``/``True``/``False`` in value position (after ``:``,
    ``,`` or ``[``), leaving text inside quoted strings alone.  The literal
    stands first in the pattern and what is before it is looked up from its end
    (over spaces, without a limit that a text could reach), so a text is
    searched for the literal instead of tried at every character."""
    t = text
    for literal, json in (("None", "null"), ("True", "true"), ("False", "false")):
        t = F.regexp_replace(t, rf"{literal}(?=\s*[,}}\]])(?<=[:\[,]\s{{0,99999999}}{literal})", json)
    return t


def without_image_names(text: Column) -> Column:
    """The text with every image name empty, for readers of the values only:
    the JSON parser copies its table of names for every text that has a new one.

    Done where every brace but the first follows an image name, no name has a
    sign of the syntax and no string an escape or other quotes, so that what is
    replaced is a name; any other text stays as it is.
    """
    mark = "\x01"
    marked = F.regexp_replace(F.concat(F.lit("}, "), F.substr(text, F.lit(2))), r"\}, '[^':,{}\[\]]++': \{", "}" + mark)
    plain = text.startswith("{'") & ~text.contains('"') & ~text.contains("\\") & ~text.contains(mark)
    named = lambda m: F.concat(F.lit("{"), F.substr(F.replace(m, F.lit("}" + mark), F.lit("}, '': {")), F.lit(4)))
    # the one-element array gives the replaced text a name, so that it is searched once
    return F.get(F.transform(F.array(marked), lambda m: F.when(plain & ~m.contains("{"), named(m)).otherwise(text)), F.lit(0))


def parse_image_map(text: Column, names: bool = True) -> Column:
    """Python-dict text -> ``map<string, struct>``; NULL when unparseable.
    Without ``names`` the values are the same, but keys may be empty."""
    return F.from_json(python_literals_to_json(text if names else without_image_names(text)), IMAGE_SCHEMA, JSON_OPTIONS)


def tags_from_map(m: Column) -> Column:
    """Union set of ``prominent_features`` over images (sorted); empty if NULL."""
    feats = F.flatten(F.transform(F.map_values(m), lambda v: F.coalesce(v["prominent_features"],
                                                                          F.array().cast("array<string>"))))
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(feats, lambda x: x.isNotNull()))),
                      F.array().cast("array<string>"))


def parse_tags(df: DataFrame, text_col: str = "parsed_output", out: str = "tags") -> DataFrame:
    return df.withColumn(out, tags_from_map(parse_image_map(F.col(text_col), names=False)))


def condition_scores(df: DataFrame, text_col: str = "parsed_output") -> DataFrame:
    """Mean granular / high condition over indoor, exterior and all images.

    One ``explode`` + one ``groupBy``; NULL values are skipped and a group
    with no value gives NULL (unparseable text gives NULL everywhere).
    """
    m = parse_image_map(F.col(text_col), names=False)
    ex = df.select("property_id", F.explode_outer(m).alias("_k", "_v"))
    v = F.col("_v")
    typ = v["image_type"]
    aggs = []
    for pre, key in (("gran", "granular_condition_num"), ("high", "high_condition_num")):
        val = v[key]
        aggs += [F.avg(F.when(typ == "Indoor", val)).alias(f"{pre}_c_in"),
                 F.avg(F.when(typ == "Exterior", val)).alias(f"{pre}_c_ex"),
                 F.avg(val).alias(f"{pre}_c")]
    return ex.groupBy("property_id").agg(*aggs)


def condition_means_long(tags_long: DataFrame) -> DataFrame:
    """Same six means from the long image table (one row per image)."""
    aggs = []
    for pre, key in (("gran", "granular_condition_num"), ("high", "high_condition_num")):
        aggs += [F.avg(F.when(F.col("image_type") == "Indoor", F.col(key))).alias(f"{pre}_c_in"),
                 F.avg(F.when(F.col("image_type") == "Exterior", F.col(key))).alias(f"{pre}_c_ex"),
                 F.avg(key).alias(f"{pre}_c")]
    return tags_long.groupBy("property_id").agg(*aggs)


def explode_tags(df: DataFrame, tags_col: str = "tags", id_col: str = "property_id") -> DataFrame:
    """Long form ``(id, tag)``, one row per distinct tag of a property."""
    return df.select(id_col, F.explode(F.array_distinct(tags_col)).alias("tag"))


def tag_counts(long: DataFrame, id_col: str = "property_id") -> DataFrame:
    """Documents per tag (long form is distinct per document)."""
    return long.groupBy("tag").agg(F.count(F.lit(1)).alias("n_docs"))


def frequency_rank(counts: DataFrame, name: str = "rank", count_col: str = "n_docs", tag_col: str = "tag") -> DataFrame:
    """counts with the row number (int) by count descending, then tag.

    Rows are dealt by range of that order and numbered within their range; the
    rows of the ranges before are added, so no task orders the vocabulary.
    The dealt rows are written, so that a task run again finds its range.
    """
    order = [F.col(count_col).desc(), F.col(tag_col)]
    dealt = stored(counts.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)          # a row a range
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_nth", within).join(starts, "_range").withColumn(name, (F.col("_start") + F.col("_nth")).cast("int")).drop("_range", "_nth", "_start")



def top_n(counts: DataFrame, n: int, count_col: str = "n_docs", key: str = "tag") -> DataFrame:
    """The ``n`` most frequent keys, ties by key; adds 1-based ``rank``.

    ``orderBy().limit()`` is a TakeOrderedAndProject: each partition keeps
    its own top n, so at most ``n`` rows per partition are shuffled.
    """
    top = counts.orderBy(F.col(count_col).desc(), F.col(key)).limit(n)
    w = Window.orderBy(F.col(count_col).desc(), F.col(key))
    return top.withColumn("rank", F.row_number().over(w))


def sanitize_name(tag: str) -> str:
    """Column name of a tag: spaces to ``_``, at most 50 characters."""
    return tag.replace(" ", "_")[:50]


def tag_onehot(df: DataFrame, vocab: list[str], tags_col: str = "tags", keep=("property_id",)) -> DataFrame:
    """One 0/1 column per vocabulary tag (names sanitised, made unique).

    ``vocab`` is a top-N list (N fixed by the caller), so the projection
    width is bounded; each flag is an ``array_contains`` in codegen.
    """
    cols, used = [], set(df.columns)
    for i, tag in enumerate(vocab):
        name = sanitize_name(tag)
        if name in used:
            name = f"{name}_{i}"
        used.add(name)
        cols.append(F.array_contains(F.col(tags_col), F.lit(tag)).cast("tinyint").alias(name))
    return df.select(*keep, *cols)


def canonicalise(df: DataFrame, mapping: DataFrame, tags_col: str = "tags") -> DataFrame:
    """Replace every tag by its canonical form (``mapping``: tag, canonical).

    Done on the long form with a left join (the mapping holds at most the
    dedupe top-N rows plus identities) and re-collected per property.
    """
    long = df.select("property_id", F.explode_outer(tags_col).alias("tag"))
    m = mapping.select(F.col("tag").alias("_t"), "canonical")
    j = long.join(m, long.tag == m._t, "left")
    out = j.groupBy("property_id").agg(
        F.array_sort(F.array_distinct(F.collect_list(F.coalesce("canonical", "tag")))).alias(tags_col))
    return out


# --------------------------------------------------------------------------
# Fuzzy canonicalisation
# --------------------------------------------------------------------------

def fuzzy_edges(vocab: DataFrame, threshold: int = 3) -> DataFrame:
    """Pairs ``(tag, earlier)`` with ``earlier < tag`` and case-folded edit
    distance <= threshold.

    Edit distance is at least the length difference, so the pairs are found
    with an equi-join on length (each tag probes ``len-threshold ..
    len+threshold``) instead of a Cartesian product.
    """
    folded = F.length(F.lower("tag"))                      # folding can change the length
    a = vocab.select(F.col("tag").alias("a"), folded.alias("la"))
    b = (vocab.select(F.col("tag").alias("b"), folded.alias("lb"))
              .withColumn("_d", F.explode(F.sequence(F.lit(-threshold), F.lit(threshold))))
              .withColumn("_la", F.col("lb") + F.col("_d")))
    j = a.join(b, a.la == b._la).filter(F.col("b") < F.col("a"))
    dist = F.levenshtein(F.lower("a"), F.lower("b"), threshold)
    return (j.select(F.col("a").alias("tag"), F.col("b").alias("earlier"), dist.alias("distance"))
             .filter(F.col("distance") >= 0))


def fuzzy_canonical(tag_doc_counts: DataFrame, top: int = 2000, threshold: int = 3) -> DataFrame:
    """Greedy canonical map of the ``top`` most frequent tags.

    In sorted order, a tag maps to the nearest earlier *canonical* tag within
    ``threshold`` (ties: the earliest), otherwise it becomes canonical.  The
    order dependence is resolved in rounds: a tag is decided once all its
    earlier neighbours are decided.  Every round is a join on the (at most
    ``top``-node) edge table; tags outside the top map to themselves
    (handled by :func:`canonicalise`).
    """
    vocab = top_n(tag_doc_counts, top).select("tag").checkpoint(eager=True)
    edges = fuzzy_edges(vocab, threshold).cache()
    spark = vocab.sparkSession
    decided = spark.createDataFrame([], "tag string, canonical string, is_canonical boolean")
    undecided = vocab
    while not undecided.isEmpty():
        und = undecided.select(F.col("tag").alias("_u"))
        # tags whose earlier neighbours are all decided
        blocked = edges.join(und, edges.earlier == und._u, "left_semi").select("tag").distinct()
        ready = undecided.join(blocked, "tag", "left_anti")
        canon = decided.filter("is_canonical").select(F.col("tag").alias("_c"))
        cand = (ready.join(edges, "tag").join(canon, F.col("earlier") == F.col("_c"))
                     .groupBy("tag")
                     .agg(F.min_by("earlier", F.struct("distance", "earlier")).alias("canonical")))
        step = (ready.join(cand, "tag", "left")
                     .select("tag", F.coalesce("canonical", "tag").alias("canonical"),
                             F.col("canonical").isNull().alias("is_canonical")))
        step = step.checkpoint(eager=True)
        if step.isEmpty():                                 # the earliest undecided tag is always ready
            raise RuntimeError("no tag could be decided")
        decided = decided.unionByName(step).checkpoint(eager=True)
        undecided = undecided.join(step.select("tag"), "tag", "left_anti").checkpoint(eager=True)
    return decided.select("tag", "canonical")


# --------------------------------------------------------------------------
# Pairs and triples
# --------------------------------------------------------------------------

def combinations(arr: Column, k: int) -> Column:
    """All sorted k-combinations (k = 2 or 3) of a sorted distinct array,
    as an array of ``array<string>``; built with higher-order functions."""
    n = F.size(arr)
    idx = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    if k == 2:
        return F.filter(F.flatten(F.transform(idx, lambda i: F.transform(
            F.sequence(i + 1, F.greatest(n - 1, i + 1)),
            lambda j: F.when(j < n, F.array(F.element_at(arr, i + 1), F.element_at(arr, j + 1)))))),
            lambda x: x.isNotNull() & (n >= 2))
    if k == 3:
        return F.filter(F.flatten(F.flatten(F.transform(idx, lambda i: F.transform(
            F.sequence(i + 1, F.greatest(n - 1, i + 1)), lambda j: F.transform(
                F.sequence(j + 1, F.greatest(n - 1, j + 1)),
                lambda m: F.when((j < n) & (m < n) & (m > j),
                                 F.array(F.element_at(arr, i + 1), F.element_at(arr, j + 1),
                                         F.element_at(arr, m + 1)))))))),
            lambda x: x.isNotNull() & (n >= 3))
    raise ValueError("k must be 2 or 3")


def combo_counts(df: DataFrame, vocab: DataFrame, k: int, tags_col: str = "tags") -> DataFrame:
    """Counts of sorted k-combinations of each id's tags restricted to the
    vocabulary (at most the top-N terms, so it is a set of literals): rows drop
    other tags before they are shuffled; partial aggregation map-side."""
    terms = [r["tag"] for r in vocab.select("tag").collect()]
    kept = df.select("property_id", F.filter(tags_col, lambda t: t.isin(terms)).alias("_k"))
    per = (kept.select("property_id", F.explode(F.array("_k")).alias("_k")).where(F.size("_k") > 0)     # filtered once, see text.combined_document
               .groupBy("property_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_k")))).alias("_t")))
    combos = per.select(F.explode(combinations(F.col("_t"), k)).alias("_c"))
    names = ["feature_1", "feature_2", "feature_3"][:k]
    return (combos.groupBy("_c").agg(F.count(F.lit(1)).alias("count"))
                  .select(*[F.col("_c")[i].alias(n) for i, n in enumerate(names)], "count"))


def top_combos(counts: DataFrame, n: int, k: int) -> DataFrame:
    names = ["feature_1", "feature_2", "feature_3"][:k]
    order = [F.col("count").desc()] + [F.col(c) for c in names]
    prefix = "pair" if k == 2 else "trip"
    top = counts.orderBy(*order).limit(n)
    return top.withColumn("column_name", F.concat(F.lit(prefix + "_"),
                                                  F.row_number().over(Window.orderBy(*order)).cast("string")))


def set_flags(df: DataFrame, values=(), keep: str = "property_id") -> DataFrame:
    """A wide frame as rows (keep, column_name, value): flags that are 1, and
    the columns in ``values`` where they are not null."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value"), F.lit(c in values).alias("any"))
                      for c in df.columns if c != keep])
    shown = F.filter(cells, lambda x: x["value"].isNotNull() & (x["any"] | (x["value"] == 1)))
    return df.select(keep, F.explode(shown).alias("x")).select(keep, "x.column_name", "x.value")


def combo_indicators(df: DataFrame, definitions: list[tuple[str, list[str]]], tags_col: str = "tags",
                     keep=("property_id",)) -> DataFrame:
    """0/1 column per definition: all member tags present."""
    cols = [reduce(lambda a, b: a & b, [F.array_contains(F.col(tags_col), F.lit(t)) for t in members])
            .cast("tinyint").alias(name) for name, members in definitions]
    return df.select(*keep, *cols)
