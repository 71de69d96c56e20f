"""Parsing and text edge cases."""

from pyspark.sql import functions as F

from propval.operators import tags as TG
from propval.operators import text as TX


def test_dict_text_literals_and_bad_input(spark):
    rows = [(1, "{1: {'prominent_features': ['Wood Floors', \"owner's suite\"], 'image_type': 'Indoor', "
                "'granular_condition_num': None, 'high_condition_num': 4.0, 'flag': True}}"),
            (2, "{1: {'prominent_features': ['broken'"),
            (3, None),
            (4, "{'a': {'prominent_features': ['None of these'], 'image_type': 'Exterior', "
                "'granular_condition_num': 2.0, 'high_condition_num': False}}")]
    df = spark.createDataFrame(rows, "property_id long, parsed_output string")
    t = {r.property_id: r.tags for r in TG.parse_tags(df).collect()}
    assert t[1] == ["Wood Floors", "owner's suite"]
    assert t[2] == [] and t[3] == []
    assert t[4] == ["None of these"]
    c = {r.property_id: r for r in TG.condition_scores(df).collect()}
    assert c[1].gran_c is None and c[1].high_c_in == 4.0
    assert c[2].gran_c is None


def test_clean_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("The Stunning 3-bed home, w/ big yard & new roof!",), ("",), (None,)], "t string")
    toks = df.select(TX.clean_tokens(F.col("t")).alias("k")).withColumn("g", TX.ngrams(F.col("k"))).collect()
    assert toks[0].k == ["home", "big", "yard", "new", "roof"]
    assert toks[0].g == ["home_big", "big_yard", "yard_new", "new_roof", "home_big_yard", "big_yard_new",
                         "yard_new_roof"]
    assert toks[1].k == [] and toks[1].g == [] and toks[2].g == []


def test_combinations(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["x"],), ([],)], "t array<string>")
    r = df.select(TG.combinations(F.col("t"), 2).alias("p"), TG.combinations(F.col("t"), 3).alias("q")).collect()
    assert len(r[0].p) == 6 and len(r[0].q) == 4 and ["a", "b", "d"] in r[0].q
    assert r[1].p == [] and r[2].q == []


def test_canonical_tags_use_the_fuzzy_map(spark, sf):
    from propval.plans import registry
    registry.load_all()
    mapping = {r.tag: r.canonical for r in registry.QUERIES["q_fuzzy_canonical"](spark, sf).collect()}
    assert all(mapping[c] == c for c in mapping.values())
    raw = {r.property_id: r.tags_text for r in registry.QUERIES["q_parse_tags"](spark, sf).collect()}
    got = {r.property_id: r.tags_text for r in registry.QUERIES["q_canonical_tags"](spark, sf).collect()}
    want = {k: "|".join(sorted({mapping.get(t, t) for t in v.split("|") if t})) for k, v in raw.items()}
    assert got == want


def test_image_values_without_names_are_the_values_with_names(spark):
    image = "{'prominent_features': ['%s'], 'image_type': 'Indoor', 'granular_condition_num': None, 'high_condition_num': 2.5, 'is_primary': True}"
    plain = "{" + ", ".join(f"'{i}_7_9': " + image % f"tag {i}" for i in range(3)) + "}"
    odd = ["{}", None, "", "'" + plain, plain[:-3], plain.replace("1_7_9", "2_7_9"), plain.replace("1_7_9", "a: {, b"), plain.replace("tag 1", "a}, 'b"),
           plain.replace("'tag 1'", '"it\'s }, \'k\': { here"'), plain.replace("tag 1", "a\\', }, \\'b\\': {"), plain.replace("tag 1", "}, {"),
           plain.replace("'tag 1'", "'x', {'y': {'z': 1}, 'w': {'z': 2}}"), plain.replace("'Indoor'", "{'a': {}, 'b': {}}"), plain.replace("2.5", "'high'"),
           plain.replace("tag 1", "a\x01b"), plain.replace("}, '", "} , '"), "{'': " + image % "no name" + "}", " " + plain, plain.replace("tag 1", "größe, None")]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([plain, *odd])], "id long, t string")
    values = lambda names: F.map_values(TG.parse_image_map(F.col("t"), names))
    rows = d.select("id", "t", values(True).alias("a"), values(False).alias("b"), TG.without_image_names(F.col("t")).alias("n")).orderBy("id").collect()
    assert all(r.a == r.b for r in rows)
    assert rows[0].n.count("'': {") == 3 and "_7_9" not in rows[0].n and len(rows[0].a) == 3
    keep = {r.id for r in rows if r.n == r.t}
    assert {1, 3, 4, 7, 9, 10, 11, 12, 13, 15} <= keep
    got = d.select("id", TX.image_features_in_order(TG.parse_image_map(F.col("t"), names=False)).alias("f")).where("id = 0").first()
    assert got.f == ["tag 0", "tag 1", "tag 2"]


def test_ngrams_are_joined_from_the_shorter_ones(spark):
    d = spark.createDataFrame([(n, [f"w{i}" for i in range(n)]) for n in range(6)] + [(6, None)], "n int, tk array<string>")
    for low, high in ((1, 1), (1, 3), (2, 2), (2, 3), (2, 4), (3, 3)):
        for r in d.select("n", "tk", TX.ngrams(F.col("tk"), low, high).alias("g")).collect():
            if r.tk is not None:
                assert r.g == ["_".join(r.tk[i:i + k]) for k in range(low, high + 1) for i in range(len(r.tk) - k + 1)]
    plan = d.select(TX.ngrams(F.col("tk"), 2, 3).alias("g"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 2                                   # bigrams are joined once
