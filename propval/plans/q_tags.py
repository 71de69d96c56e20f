"""Queries over image tags (survey 2.10 tag rows, 2.4 tag counts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propval.operators import tags as TG
from propval.plans.oracle_fixtures import with_fx
from propval.plans.registry import query, rounded
from propval.sources import fixtures as fx
from propval.sources.io import stored

N_SINGLES, N_PAIRS, N_TRIPLES = 300, 20, 20
DEDUPE_TOP, DEDUPE_THRESHOLD = 2000, 3


def _vocab(t, n=N_SINGLES):
    return TG.top_n(TG.tag_counts(TG.explode_tags(t)), n)


def _tagged(spark, sf):
    """The tag sets, parsed once for the vocabulary and what is done with it."""
    return stored(fx.tagged(spark, sf), "tags")


@query("q_parse_tags", with_fx("""
SELECT property_id, CAST(len(tags) AS INTEGER) AS n_tags, array_to_string(tags, '|') AS tags_text FROM fx_tagged""",
                               ["fx_tagged"]))
def q_parse_tags(spark, sf):
    """Python-dict text -> union set of prominent features (empty if bad/NULL)."""
    t = fx.tagged(spark, sf)
    return t.select("property_id", F.size("tags").alias("n_tags"),
                    F.array_join("tags", "|").alias("tags_text"))


_COND = ["gran_c_in", "gran_c_ex", "gran_c", "high_c_in", "high_c_ex", "high_c"]


@query("q_condition_scores", rounded(with_fx("""
SELECT property_id,
  AVG(CASE WHEN ok AND image_type = 'Indoor' THEN granular_condition_num END) AS gran_c_in,
  AVG(CASE WHEN ok AND image_type = 'Exterior' THEN granular_condition_num END) AS gran_c_ex,
  AVG(CASE WHEN ok THEN granular_condition_num END) AS gran_c,
  AVG(CASE WHEN ok AND image_type = 'Indoor' THEN high_condition_num END) AS high_c_in,
  AVG(CASE WHEN ok AND image_type = 'Exterior' THEN high_condition_num END) AS high_c_ex,
  AVG(CASE WHEN ok THEN high_condition_num END) AS high_c
FROM (SELECT *, property_id % 50 NOT IN (7, 13) AS ok FROM fx_image_tags) t
GROUP BY property_id""", ["fx_image_tags"]), _COND))
def q_condition_scores(spark, sf):
    """Six image-condition means per property (indoor / exterior / all)."""
    return TG.condition_scores(fx.parsed_output(spark, sf))


@query("q_tag_counts", with_fx("""
SELECT tag, n_docs, CAST(ROW_NUMBER() OVER (ORDER BY n_docs DESC, tag) AS INTEGER) AS rank
FROM fx_tag_counts""", ["fx_tag_counts"]))
def q_tag_counts(spark, sf):
    """Documents per tag with frequency rank (ties by tag)."""
    counts = TG.tag_counts(TG.explode_tags(fx.tagged(spark, sf)))
    return TG.frequency_rank(counts)


_TOP = f"(SELECT tag FROM fx_tag_counts ORDER BY n_docs DESC, tag LIMIT {N_SINGLES})"


@query("q_tag_onehot", with_fx(f"""
SELECT DISTINCT property_id, LEFT(REPLACE(tag, ' ', '_'), 50) AS column_name, CAST(1 AS DOUBLE) AS value
FROM fx_tag_long WHERE tag IN {_TOP}""", ["fx_tag_long", "fx_tag_counts"]))
def q_tag_onehot(spark, sf):
    """Top-300 tags as 0/1 columns (vocabulary of bounded size); the wide
    frame is read back as (property_id, column_name, value), ones only."""
    t = _tagged(spark, sf)
    vocab = [r.tag for r in _vocab(t).select("tag").collect()]
    return TG.set_flags(TG.tag_onehot(t, vocab))


def _combo_sql(k: int, n: int) -> str:
    names = ["feature_1", "feature_2", "feature_3"][:k]
    al = ["a", "b", "c"][:k]
    frm = ", ".join(f"kept {x}" for x in al)
    conds = [f"{al[i]}.property_id = {al[0]}.property_id" for i in range(1, k)]
    conds += [f"{al[i]}.tag < {al[i + 1]}.tag" for i in range(k - 1)]
    sel = ", ".join(f"{x}.tag AS {nm}" for x, nm in zip(al, names))
    grp = ", ".join(names)
    prefix = "pair" if k == 2 else "trip"
    return f"""
SELECT '{prefix}_' || CAST(ROW_NUMBER() OVER (ORDER BY count DESC, {grp}) AS STRING) AS column_name, {grp}, count
FROM (SELECT {sel}, COUNT(*) AS count FROM {frm} WHERE {' AND '.join(conds)} GROUP BY {grp}) t
ORDER BY count DESC, {grp} LIMIT {n}"""


_KEPT = ("kept", f"SELECT property_id, tag FROM fx_tag_long WHERE tag IN {_TOP}")


@query("q_pair_counts", with_fx(_combo_sql(2, N_PAIRS), ["fx_tag_long", "fx_tag_counts"], [_KEPT]))
def q_pair_counts(spark, sf):
    """Top-20 sorted tag pairs among each row's top-300 tags."""
    t = _tagged(spark, sf)
    return TG.top_combos(TG.combo_counts(t, _vocab(t), 2), N_PAIRS, 2) \
             .select("column_name", "feature_1", "feature_2", "count")


@query("q_triple_counts", with_fx(_combo_sql(3, N_TRIPLES), ["fx_tag_long", "fx_tag_counts"], [_KEPT]))
def q_triple_counts(spark, sf):
    """Top-20 sorted tag triples among each row's top-300 tags."""
    t = _tagged(spark, sf)
    return TG.top_combos(TG.combo_counts(t, _vocab(t), 3), N_TRIPLES, 3) \
             .select("column_name", "feature_1", "feature_2", "feature_3", "count")


@query("q_pair_onehot", with_fx(f"""
SELECT DISTINCT k.property_id, d.column_name, CAST(1 AS DOUBLE) AS value FROM defs d
JOIN kept k1 ON k1.tag = d.feature_1 JOIN kept k ON k.property_id = k1.property_id AND k.tag = d.feature_2""",
    ["fx_tag_long", "fx_tag_counts"], [_KEPT, ("defs", _combo_sql(2, N_PAIRS))]))
def q_pair_onehot(spark, sf):
    """0/1 indicator per top pair: both member tags present (read back as
    (property_id, column_name, value), ones only)."""
    t = _tagged(spark, sf)
    defs = TG.top_combos(TG.combo_counts(t, _vocab(t), 2), N_PAIRS, 2).collect()   # <= 20 rows
    return TG.set_flags(TG.combo_indicators(t, [(r.column_name, [r.feature_1, r.feature_2]) for r in defs]))


@query("q_triple_onehot", with_fx(f"""
SELECT DISTINCT k.property_id, d.column_name, CAST(1 AS DOUBLE) AS value FROM defs d
JOIN kept k1 ON k1.tag = d.feature_1 JOIN kept k2 ON k2.property_id = k1.property_id AND k2.tag = d.feature_2
JOIN kept k ON k.property_id = k1.property_id AND k.tag = d.feature_3""",
    ["fx_tag_long", "fx_tag_counts"], [_KEPT, ("defs", _combo_sql(3, N_TRIPLES))]))
def q_triple_onehot(spark, sf):
    """0/1 indicator per top triple: all member tags present (ones only)."""
    t = _tagged(spark, sf)
    defs = TG.top_combos(TG.combo_counts(t, _vocab(t), 3), N_TRIPLES, 3).collect()   # <= 20 rows
    return TG.set_flags(TG.combo_indicators(t, [(r.column_name, [r.feature_1, r.feature_2, r.feature_3]) for r in defs]))


@query("q_fuzzy_edges", with_fx(f"""
SELECT a.tag AS tag, b.tag AS earlier, CAST(levenshtein(lower(a.tag), lower(b.tag)) AS INTEGER) AS distance
FROM top a, top b
WHERE b.tag < a.tag AND levenshtein(lower(a.tag), lower(b.tag)) <= {DEDUPE_THRESHOLD}""",
    ["fx_tag_counts"], [("top", f"SELECT tag FROM fx_tag_counts ORDER BY n_docs DESC, tag LIMIT {DEDUPE_TOP}")]))
def q_fuzzy_edges(spark, sf):
    """Edit-distance edges (<= 3, case-folded) among the top-2000 tags."""
    vocab = _vocab(fx.tagged(spark, sf), DEDUPE_TOP).select("tag").checkpoint(eager=True)       # both sides of the join
    return TG.fuzzy_edges(vocab, DEDUPE_THRESHOLD)


@query("q_fuzzy_canonical")
def q_fuzzy_canonical(spark, sf):
    """Greedy canonical map of the top-2000 tags (rounds over the edge table);
    checked against a brute-force greedy pass in tests."""
    counts = TG.tag_counts(TG.explode_tags(fx.tagged(spark, sf)))
    return TG.fuzzy_canonical(counts, DEDUPE_TOP, DEDUPE_THRESHOLD)


@query("q_canonical_tags")
def q_canonical_tags(spark, sf):
    """Every property's tags in canonical spelling: the fuzzy map applied to
    the tag sets that feed flags, pairs and topics."""
    t = _tagged(spark, sf)
    mapping = TG.fuzzy_canonical(TG.tag_counts(TG.explode_tags(t)), DEDUPE_TOP, DEDUPE_THRESHOLD)
    return TG.canonicalise(t, mapping).select("property_id", F.array_join("tags", "|").alias("tags_text"))


_WIDE = _COND + ["sale_price", "living_sqft"]


@query("q_image_wide", rounded(with_fx(f"""
SELECT DISTINCT property_id, LEFT(REPLACE(tag, ' ', '_'), 50) AS column_name, CAST(1 AS DOUBLE) AS value FROM fx_image_tags
WHERE tag IN (SELECT tag FROM (SELECT tag, COUNT(DISTINCT property_id) AS n FROM fx_image_tags GROUP BY tag) ORDER BY n DESC, tag LIMIT {N_SINGLES})
UNION ALL
SELECT property_id, column_name, value FROM (
  SELECT c.*, CAST(e.sale_price AS DOUBLE) AS sale_price, CAST(e.living_sqft AS DOUBLE) AS living_sqft
  FROM (SELECT property_id,
          AVG(CASE WHEN image_type = 'Indoor' THEN granular_condition_num END) AS gran_c_in,
          AVG(CASE WHEN image_type = 'Exterior' THEN granular_condition_num END) AS gran_c_ex,
          AVG(granular_condition_num) AS gran_c,
          AVG(CASE WHEN image_type = 'Indoor' THEN high_condition_num END) AS high_c_in,
          AVG(CASE WHEN image_type = 'Exterior' THEN high_condition_num END) AS high_c_ex,
          AVG(high_condition_num) AS high_c
        FROM fx_image_tags GROUP BY property_id) c LEFT JOIN fx_extract e USING (property_id)) w
CROSS JOIN LATERAL (VALUES {", ".join(f"('{c}', w.{c})" for c in _WIDE)}) v(column_name, value)
WHERE value IS NOT NULL""", ["fx_image_tags", "fx_extract"]), ["value"]))
def q_image_wide(spark, sf):
    """Expanded image table: top-300 tag flags + 6 condition scores next to
    property columns (image LEFT JOIN extract), read back as (property_id,
    column_name, value): flags that are 1 and values that are there."""
    from propval.plans.q_extract import extract
    long = fx.image_tags(spark, sf)
    sets = long.groupBy("property_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    vocab = [r.tag for r in TG.top_n(TG.tag_counts(TG.explode_tags(sets)), N_SINGLES).select("tag").collect()]
    flags = TG.tag_onehot(sets, vocab)
    cond = TG.condition_means_long(long)
    e = extract(spark, sf).select("property_id", "sale_price", "living_sqft")
    return TG.set_flags(flags.join(cond, "property_id").join(e, "property_id", "left"), values=_WIDE)
