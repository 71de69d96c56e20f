"""Learned and randomised operators (survey 2.9 forests / clusters, 2.10
topic models, 2.11 models and experiments).  No SQL oracle: these are
covered by seeded property tests (tests/test_models.py)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from propval.functions import tiers
from propval.operators import boosting as BO
from propval.operators import features as FE
from propval.operators import importance as IM
from propval.operators import metrics as M
from propval.operators import models as MD
from propval.operators import schema as S
from propval.operators import tags as TG
from propval.operators import text as TX
from propval.operators import topics as TP
from propval.operators.iforest import isolation_forest
from propval.operators.topic_reports import dominant_topic
from propval.plans.q_extract import LEAKY_COLUMNS, ID_COLUMNS, extract
from propval.plans.q_features import prior_sale_input
from propval.plans.q_metrics import topic_table
from propval.plans.registry import query
from propval.sources import fixtures as fx
from propval.sources.artifacts import load_artifact, save_artifact
from propval.sources.io import output_dir, stored

POOLED_FEATURES = ["living_sqft", "lot_sqft", "year_built", "bedrooms", "full_baths", "garage_spaces",
                   "latitude", "longitude", "sqft_per_bedroom", "lot_to_living_ratio", "property_age", "log_sqft",
                   "luxury_score", "prior_sale_price", "years_since_last_sale", "median_household_income",
                   "pct_bachelors_degree", "median_home_value", "per_gop"]
POOLED_COLUMNS = ["property_id", "sale_price", "price_tier", *POOLED_FEATURES]
LISTING_FEATURES = ["gla_sqft", "lot_sqft", "bedrooms", "full_baths", "total_baths", "property_age",
                    "effective_age", "gla_to_lot_ratio", "sqft_per_bedroom", "has_garage", "has_pool",
                    "has_fireplace", "hoa_monthly", "latitude", "longitude"]
LISTING_COLUMNS = ["cc_list_id", "price", "router_tier", *LISTING_FEATURES]
N_ROUNDS = 500


def pooled_frame(spark, sf):
    d = FE.features_prior_sale(FE.features_pooled(prior_sale_input(spark, sf)))
    return d.withColumn("price_tier", tiers.price_tier(F.col("sale_price"), tiers.PRICE_TIERS_POOLED))


def listing_frame(spark, sf):
    d = FE.drop_leaky(fx.listings(spark, sf), LEAKY_COLUMNS + ID_COLUMNS, "price")
    d = FE.features_listing(d.filter(F.col("price").between(10000, 10000000)))
    return d.withColumn("router_tier", tiers.router_tier(F.col("price")))


def _shared(df, *columns):
    """The training frame shared by several model fits (or these columns of it):
    computed once and stored under spark.checkpoint.dir, so each tier or method
    reads it instead of re-deriving extract, clusters and filters."""
    return stored(df.select(*columns) if columns else df, "shared")


def _split(df, id_col, frac=0.7):
    tr = FE.hash_split(F.col(id_col), frac)
    return df.filter(tr), df.filter(~tr)


@query("q_quantile_gbt")
def q_quantile_gbt(spark, sf):
    """q10 / q50 / q90 pinball models on log1p(price), 500 rounds each, test
    predictions with crossing fixed."""
    train, test = _split(_shared(pooled_frame(spark, sf), *POOLED_COLUMNS), "property_id")
    train, test = MD.prepare_features(train, test, POOLED_FEATURES)
    model = MD.quantile_boost(train, POOLED_FEATURES, "sale_price", n_rounds=N_ROUNDS)
    p = model.predict(test.select("property_id", "sale_price", *POOLED_FEATURES))
    return p.select("property_id", F.col("sale_price").alias("actual"), "pred_q10", "pred_q50", "pred_q90") \
            .withColumns(MD.fix_crossing("pred_q10", "pred_q50", "pred_q90"))


@query("q_gbt_price")
def q_gbt_price(spark, sf):
    """Squared-loss boosted trees, 300 rounds, on listing features (80/20 hash split)."""
    train, test = _split(_shared(listing_frame(spark, sf), *LISTING_COLUMNS), "cc_list_id", 0.8)
    train, test = MD.prepare_features(train, test, LISTING_FEATURES)
    models = MD.boosted(train, LISTING_FEATURES, "price", "cc_list_id")
    return BO.score(test, LISTING_FEATURES, list(models.values()), {"predicted": "price"}).select("cc_list_id", F.col("price").alias("actual"), "predicted")


def _depth_grid(spark, sf):
    """Per router tier, depths 6 to 16 at 500 rounds, on a validation bucket of
    the train split (the test set is not used for selection)."""
    train, test = _split(_shared(listing_frame(spark, sf), *LISTING_COLUMNS), "cc_list_id", 0.8)
    fit, valid = _split(train, "cc_list_id", 0.64)
    medians = FE.medians_of_stored(fit, LISTING_FEATURES)
    fit, valid, test = (FE.fill_medians(x, medians) for x in (fit, valid, test))
    return (*MD.depth_grid(fit, valid, LISTING_FEATURES, "price", "router_tier", rounds=N_ROUNDS, id_col="cc_list_id"), test)


@query("q_depth_sweep")
def q_depth_sweep(spark, sf):
    """Metrics of every tier and depth, the best depth of each tier marked."""
    return _depth_grid(spark, sf)[0]


@query("q_depth_predictions")
def q_depth_predictions(spark, sf):
    """Test rows scored by the best depth of their tier."""
    _, models, best, test = _depth_grid(spark, sf)
    depth = dict(best.collect())                                                                     # one row per tier
    chosen = [m for m in models.values() if m.name == f"d{depth.get(int(m.group))}|{m.group}"]
    for m in chosen:
        m.name = f"best|{m.group}"
    p = BO.score(test, LISTING_FEATURES, chosen, {"predicted": "best"}, "router_tier").withColumn("predicted", F.expm1("predicted"))
    return p.join(best, "router_tier").select("cc_list_id", "router_tier", "best_depth", F.col("price").alias("actual"), "predicted")


@query("q_depth_importance")
def q_depth_importance(spark, sf):
    """Importances of the best depth of each tier, ranked with shares."""
    _, models, best, test = _depth_grid(spark, sf)
    n = dict(test.groupBy("router_tier").count().collect())                                          # one row per tier
    rows = [(int(m.group), f, float(x), n.get(int(m.group), 0)) for t, d in best.collect() for m in [models[f"d{d}|{t}"]]
            for f, x in zip(LISTING_FEATURES, m.gain, strict=True)]
    return IM.importance_rank(spark.createDataFrame(rows, "tier int, feature string, importance double, n_test long"))


def _tier_predictions(spark, sf):
    """Test predictions of all pooled tiers (at least 50 rows before and after
    the outlier filter): 70/30 split, then train-only cluster target encoding
    and medians per tier, and q10 / q50 / q90 models of all tiers in one job."""
    d = FE.geo_clusters(_shared(pooled_frame(spark, sf), *POOLED_COLUMNS))
    kept, _ = FE.outlier_filter(d, "sale_price")
    kept = kept.withColumn("_train", FE.hash_split(F.col("property_id"), 0.7))
    n = {r[0]: r[1] for r in d.groupBy("price_tier").count().collect()}                               # one row per tier
    m = {r[0]: r[1] for r in kept.groupBy("price_tier").count().collect()}
    rows = kept.filter(F.col("price_tier").isin([t for t in tiers.TIER_ORDER if min(n.get(t, 0), m.get(t, 0)) >= 50]))
    feats = POOLED_FEATURES + ["cluster_avg_price", "cluster_med_price"]
    rows = _shared(FE.cluster_target_stats_by(rows, F.col("_train"), "sale_price", "price_tier"))
    rows = FE.fill_medians_by(rows, F.col("_train"), feats, "price_tier")
    model = MD.quantile_boost(rows.filter("_train"), feats, "sale_price", n_rounds=N_ROUNDS, group="price_tier")
    p = model.predict(rows.filter(~F.col("_train")).select("property_id", "sale_price", "price_tier", *feats))
    return rows, model, p.withColumns(MD.fix_crossing("pred_q10", "pred_q50", "pred_q90")).select(
        "property_id", "price_tier", F.col("sale_price").alias("actual"), F.col("pred_q50").alias("predicted"),
        F.col("pred_q10").alias("pred_lower"), F.col("pred_q90").alias("pred_upper"))


@query("q_pooled_tiers")
def q_pooled_tiers(spark, sf):
    """Test predictions of the pooled tier models."""
    return _tier_predictions(spark, sf)[2]


@query("q_pooled_tier_metrics")
def q_pooled_tier_metrics(spark, sf):
    """Per pooled tier: rows, MAPE, MAE, R2 and coverage of the 80 % interval."""
    rows, _, p = _tier_predictions(spark, sf)
    train = rows.filter("_train").groupBy("price_tier").agg(F.count("*").alias("n_train"))
    return train.join(MD.tier_metrics(p, "price_tier"), "price_tier")


@query("q_isolation_forest")
def q_isolation_forest(spark, sf):
    """Isolation forest (100 trees x 256 rows, 5 % contamination) on living
    area, lot, price and year."""
    e = extract(spark, sf)
    return isolation_forest(e, ["living_sqft", "lot_sqft", "sale_price", "year_built"], "property_id")


@query("q_outlier_filter_forest")
def q_outlier_filter_forest(spark, sf):
    """Statistics of the sequential outlier filter with the isolation forest
    as its last step, per extreme tier."""
    _, stats = FE.outlier_filter_forest(_shared(pooled_frame(spark, sf), *POOLED_COLUMNS), "sale_price", ["living_sqft", "lot_sqft", "sale_price", "year_built"], "property_id")
    return stats


@query("q_model_importance")
def q_model_importance(spark, sf):
    """Feature importances of a boosted model per router tier (at least 50
    training rows), ranked with shares; n_test weighs tiers."""
    d = _shared(listing_frame(spark, sf), *LISTING_COLUMNS)
    train, test = _split(d, "cc_list_id", 0.8)
    n = {(r[0], r[1]): r[2] for r in d.groupBy("router_tier", FE.hash_split(F.col("cc_list_id"), 0.8)).count().collect()}   # two rows per tier

    enough = [t for t in (0, 1, 2) if n.get((t, True), 0) >= 50]
    rows = FE.fill_medians_by(train.filter(F.col("router_tier").isin(enough)), F.lit(True), LISTING_FEATURES, "router_tier")
    found = MD.boosted(rows, LISTING_FEATURES, "price", "cc_list_id", "router_tier")
    rows = [(int(m.group), f, float(x), n.get((int(m.group), False), 0)) for m in found.values() for f, x in zip(LISTING_FEATURES, m.gain, strict=True)]
    return IM.importance_rank(spark.createDataFrame(rows, "tier int, feature string, importance double, n_test long"))


@query("q_score_listings")
def q_score_listings(spark, sf):
    """Batch scoring: fit and save a model with its feature list, load it,
    align the listings to it, fill, predict and label the confidence."""
    d = listing_frame(spark, sf)
    train, test = _split(d, "cc_list_id", 0.8)
    medians = FE.column_medians(train, LISTING_FEATURES)
    model = Pipeline(stages=[VectorAssembler(inputCols=LISTING_FEATURES, outputCol="features", handleInvalid="keep"),
                             GBTRegressor(featuresCol="features", labelCol="price", maxIter=20, maxDepth=6, seed=42)]).fit(FE.fill_medians(train, medians))
    path = save_artifact(spark, output_dir(spark, "listing-model"), model, {"features": LISTING_FEATURES, "medians": medians})
    loaded, meta = load_artifact(spark, path)
    rows = FE.fill_medians(test.select("cc_list_id", "price", *[c for c in meta["features"] if c in test.columns]), meta["medians"])
    aligned = S.align_schema(rows, meta["features"], keep=("cc_list_id", "price"))
    return loaded.transform(aligned).select("cc_list_id", F.col("price").alias("actual"), F.col("prediction").alias("predicted"),
                                            M.confidence_label(F.col("prediction")).alias("confidence"))


@query("q_tier_router")
def q_tier_router(spark, sf):
    """3-class router (200 rounds of boosting per class) on listing features; test rows."""
    train, test = _split(_shared(listing_frame(spark, sf), *LISTING_COLUMNS), "cc_list_id", 0.8)
    train, test = MD.prepare_features(train, test, LISTING_FEATURES)
    r = MD.tier_router(train, LISTING_FEATURES, "router_tier", "cc_list_id")
    return r.transform(test).select("cc_list_id", "router_tier", "pred_tier")


@query("q_routed_scoring")
def q_routed_scoring(spark, sf):
    """Route by predicted tier, then score with that tier's model."""
    train, test = _split(_shared(listing_frame(spark, sf), *LISTING_COLUMNS), "cc_list_id", 0.8)
    train, test = MD.prepare_features(train, test, LISTING_FEATURES)
    router = MD.tier_router(train, LISTING_FEATURES, "router_tier", "cc_list_id")
    models = MD.boosted(train, LISTING_FEATURES, "price", "cc_list_id", "router_tier")
    p = MD.routed_scoring(test, router, models, LISTING_FEATURES, "cc_list_id")
    return p.join(test.select("cc_list_id", F.col("price").alias("actual")), "cc_list_id")


def _tag_docs(spark, sf):
    """The tag sets, parsed once: vocabulary, fits and scoring read them again."""
    return _shared(fx.tagged(spark, sf))


@query("q_lda_topics")
def q_lda_topics(spark, sf):
    """LDA (k=10, online, 20 iterations) on the binary top-500 tag matrix."""
    out, _ = TP.lda_topics(_tag_docs(spark, sf), 10, 500, "tags")
    return out


@query("q_lda_split")
def q_lda_split(spark, sf):
    """Per router tier (by the split documents' price, 3 tiers): vocabulary (200
    terms) and LDA (k=8, word prior 0.01) fitted on the tier's train split, its
    topics cut to their top 20 terms, and every document of the tier folded in
    against them; documents without a topic term get 1/8."""
    both = TX.documents_with_comments(fx.comments(spark, sf), fx.parsed_output(spark, sf))
    docs = TX.combined_document(both, "public_listing_comments", "parsed_output", "B").select("property_id", "tokens")
    tier = pooled_frame(spark, sf).select("property_id", tiers.router_tier(F.col("sale_price")).alias("router_tier"))
    docs = _shared(docs.join(tier, "property_id", "left").withColumn("router_tier", F.coalesce("router_tier", F.lit(0))))
    is_train = FE.hash_split(F.col("property_id"), 0.7)
    found = [r[0] for r in docs.filter(is_train).groupBy("router_tier").count().where("count >= 50").collect()]       # tiers
    terms = None
    for t in sorted(found):
        own = docs.filter((F.col("router_tier") == t) & is_train)
        _, model = TP.lda_topics(own, 8, 200, "tokens", binary=False, word_prior=0.01)
        sparse = TP.sparsify_topics(TP.lda_term_weights(model, 8), 20).select(F.lit(t).alias("router_tier"), "topic", "term", "weight")
        terms = sparse if terms is None else terms.unionByName(sparse)
    cols = [f"topic_{i}" for i in range(1, 9)]
    if terms is None:
        out = docs.select("property_id", "router_tier", *[F.lit(None).cast("double").alias(c) for c in cols])
    else:
        terms = terms.checkpoint(eager=True)
        words = [r["term"] for r in terms.select("term").distinct().collect()]                       # at most 3 x 8 x 20
        known = docs.select("property_id", "router_tier", F.explode(F.filter("tokens", lambda t: t.isin(words))).alias("term"))
        counts = known.groupBy("property_id", "router_tier", "term").agg(F.count("*").alias("n"))
        folded = TP.fold_in(counts, terms, 8, steps=20, by="router_tier")
        out = docs.select("property_id", "router_tier").join(folded, "property_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(1.0 / 8)) for c in cols})
    return out.select("property_id", "router_tier", *cols, dominant_topic(cols).alias("dominant_topic"))


def _tag_tfidf(spark, sf, n=500):
    t = _tag_docs(spark, sf)
    long = TG.explode_tags(t)
    vocab = TG.top_n(TG.tag_counts(long), n)
    b = TX.binary_doc_term(long, vocab)
    return TX.tfidf_long(b, t.count(), smooth=False, term_col="tag", value_col="value") \
             .join(b.select("property_id", "tag", "term_index"), ["property_id", "tag"]), vocab.count()


@query("q_nmf_topics")
def q_nmf_topics(spark, sf):
    """NMF (k=10) on the L2 TF-IDF tag matrix, rows L1-normalised."""
    long, v = _tag_tfidf(spark, sf)
    return TP.nmf_topics(_shared(long), 10, v)


def _tag_counts_long(spark, sf, n=500):
    """Binary (property_id, tag, term_index) over the top tags of the train split."""
    long = TG.explode_tags(_tag_docs(spark, sf))
    vocab = TG.top_n(TG.tag_counts(long.filter(FE.hash_split(F.col("property_id"), 0.7))), n)
    return _shared(TX.binary_doc_term(long, vocab)), vocab.count()


def _train_tfidf(b):
    """L2-normalised TF-IDF whose document frequencies come from the train
    split alone; a tag that no train document has is left out."""
    train = b.filter(FE.hash_split(F.col("property_id"), 0.7))
    n = train.select("property_id").distinct().count()
    idf = train.groupBy("tag").agg((F.log((1.0 + n) / (1.0 + F.count("*"))) + 1.0).alias("idf"))
    w = b.join(idf, "tag")
    norm = w.groupBy("property_id").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"))
    return w.join(norm, "property_id").select("property_id", "tag", "term_index", (F.col("idf") / F.col("norm")).alias("weight"))


@query("q_nmf_split")
def q_nmf_split(spark, sf):
    """Split-safe NMF (k=8): vocabulary, document frequencies and term factors
    from the train split, all documents folded in; TF-IDF and counts forms."""
    b, v = _tag_counts_long(spark, sf)
    is_train = FE.hash_split(F.col("property_id"), 0.7)
    forms = {"tfidf": _shared(_train_tfidf(b)), "counts": b.withColumn("weight", F.lit(1.0))}
    out = [TP.nmf_topics(x, 8, v, fit_on=x.filter(is_train), alpha_w=0.0, alpha_h=0.0).withColumn("form", F.lit(name)) for name, x in forms.items()]
    return out[0].unionByName(out[1]).withColumn("is_train", is_train)


@query("q_gsdmm")
def q_gsdmm(spark, sf):
    """Dirichlet-multinomial mixture (K=10, alpha=beta=0.1, 30 sweeps) on tag
    documents; one-hot topic columns and the label of each topic's three most
    frequent tags."""
    t = _tag_docs(spark, sf)
    long = TG.explode_tags(t)
    vocab = TG.top_n(TG.tag_counts(long), 500)
    b = _shared(TX.binary_doc_term(long, vocab))
    names = b.select("term_index", F.col("tag").alias("term")).distinct()
    z = TP.gsdmm(b, vocab.count(), K=10, n_iter=30, terms=names)
    return z.select("property_id", "cluster", "label", *[(F.col("cluster") == i).cast("tinyint").alias(f"topic_{i + 1}") for i in range(10)])


@query("q_embedding_topics")
def q_embedding_topics(spark, sf):
    """Topics from the given embeddings: PCA(5) + Gaussian mixture (k=20),
    merged to 10 by the class TF-IDF of the words of the documents with the
    same ids; documents below probability 0.5 go to the most likely topic."""
    root = sf.rstrip("/")
    soft = TP.embedding_topics(spark.read.parquet(f"{root}/embeddings.parquet"), "embedding", "vec_id", k=20)
    words = spark.read.parquet(f"{root}/documents.parquet").select(F.col("doc_id").alias("vec_id"), F.explode(F.split(F.lower("text"), r"\W+")).alias("term"))
    words = words.where(F.length("term") > 2)
    common = words.groupBy("term").count().orderBy(F.desc("count"), "term").limit(500).select("term")
    return TP.merged_topics(soft, words.join(common, "term", "left_semi"), 20, 10, least=0.5)


@query("q_topic_premium")
def q_topic_premium(spark, sf):
    """OLS price ~ 8 topics: premium per 0.1 topic score and R2."""
    from pyspark.ml.regression import LinearRegression
    t = topic_table(spark, sf)
    cols = [f"topic_{i}" for i in range(1, 9)]
    d = MD.assemble(t.fillna(0.0, subset=cols), cols)
    m = LinearRegression(featuresCol="features", labelCol="sale_price", regParam=1e-6, elasticNetParam=0.0).fit(d)
    rows = [(i + 1, float(c) * 0.1) for i, c in enumerate(m.coefficients)]
    r2 = float(m.summary.r2)
    return spark.createDataFrame(rows, "topic int, premium double").withColumn("model_r2", F.lit(r2))


def _run_tiers(d, feats):
    """Test predictions of a median model per tier (70/30 hash split)."""
    d = _shared(FE.fill_medians_by(d, FE.hash_split(F.col("property_id"), 0.7), feats, "price_tier"))
    train, test = _split(d, "property_id")
    m = MD.quantile_boost(train, feats, "sale_price", quantiles=(0.5,), n_rounds=N_ROUNDS, group="price_tier", held_back=0.0)
    return m.predict(test.select("property_id", "sale_price", "price_tier", *feats)).select("property_id", "sale_price", "price_tier", "pred_q50")


@query("q_ab_experiment")
def q_ab_experiment(spark, sf):
    """Per tier: baseline features vs + LDA image topics (median boosting);
    baseline / topics MAPE, MAE, R2 and lift.  Topics are fitted on the train
    split alone."""
    base = _shared(pooled_frame(spark, sf).withColumn("price_tier", tiers.price_tier(F.col("sale_price"))), *POOLED_COLUMNS)
    docs = _tag_docs(spark, sf)
    topics, _ = TP.lda_topics(docs, 8, 500, "tags", fit_on=docs.filter(FE.hash_split(F.col("property_id"), 0.7)), word_prior=0.01)
    with_t = _shared(base.join(topics, "property_id", "left"))
    tcols = [f"topic_{i}" for i in range(1, 9)]
    a = _run_tiers(base, POOLED_FEATURES).withColumn("method", F.lit("baseline"))
    b = _run_tiers(with_t, POOLED_FEATURES + tcols).withColumn("method", F.lit("topics"))
    p = a.unionByName(b).select("property_id", "method", "price_tier", F.col("sale_price").alias("actual"),
                                F.col("pred_q50").alias("predicted"))
    return M.ab_lift(p, "method", "price_tier", "baseline", "topics")


@query("q_topic_experiment")
def q_topic_experiment(spark, sf):
    """LDA vs NMF vs embedding topics (SVD of the tag TF-IDF + mixture) with
    the same features and pooled median boosting, every method fitted on the
    train split alone; per-method comparison."""
    base = _shared(pooled_frame(spark, sf), *POOLED_COLUMNS)
    k = 8
    docs = _tag_docs(spark, sf)
    lda, _ = TP.lda_topics(docs, k, 500, "tags", fit_on=docs.filter(FE.hash_split(F.col("property_id"), 0.7)), word_prior=0.01)
    b, v = _tag_counts_long(spark, sf)
    long = _shared(_train_tfidf(b))
    is_train = FE.hash_split(F.col("property_id"), 0.7)
    nmf = TP.nmf_topics(long, k, v, fit_on=long.filter(is_train), alpha_w=0.0, alpha_h=0.0)
    sparse = long.groupBy("property_id").agg(F.map_from_entries(F.collect_list(F.struct("term_index", "weight"))).alias("_m"))
    dense = sparse.select("property_id", F.transform(F.sequence(F.lit(0), F.lit(v - 1)),
                                                     lambda j: F.coalesce(F.col("_m")[j], F.lit(0.0))).alias("emb"))
    emb = TP.embedding_topics(dense, "emb", "property_id", k=k, pca_k=5, fit_on=dense.filter(is_train)).drop("topic", "probability")
    tcols = [f"topic_{i}" for i in range(1, k + 1)]
    feats, trains, tests = POOLED_FEATURES + tcols, [], []
    for name, t in (("LDA", lda), ("NMF", nmf), ("BERTOPIC", emb)):
        d = _shared(base.join(t.select("property_id", *tcols), "property_id", "left").fillna(0.0, subset=tcols))
        train, test = _split(d, "property_id")
        for rows, to in zip(MD.prepare_features(train, test, feats), (trains, tests), strict=True):
            to.append(rows.select("property_id", "sale_price", F.lit(name).alias("method"), *feats))
    # a model for each method, all grown in one job
    m = MD.quantile_boost(reduce(lambda a, b: a.unionByName(b), trains), feats, "sale_price", quantiles=(0.5,), n_rounds=N_ROUNDS, group="method", held_back=0.0)
    preds = m.predict(reduce(lambda a, b: a.unionByName(b), tests)).select("property_id", "method", F.col("sale_price").alias("actual"), F.col("pred_q50").alias("predicted"))
    return M.method_comparison(preds, "method", "LDA")
