import uuid

from pyspark.sql import functions as F

from propval.sources import fixtures as fx
from propval.sources.io import output_dir
from propval.streaming.features import listing_stream, score_features


def test_stream_features_match_batch(spark, sf):
    src = output_dir(spark, "stream-src")
    batch = fx.listings(spark, sf).limit(200)
    batch.write.mode("overwrite").parquet(src)
    name = f"feat_{uuid.uuid4().hex[:8]}"
    q = (score_features(listing_stream(spark, src, batch.schema)).writeStream.format("memory")
         .queryName(name).outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql(f"SELECT * FROM {name}")
    expect = score_features(spark.read.parquet(src))
    assert got.count() == 200
    assert got.select(*expect.columns).exceptAll(expect).count() == 0


def test_artifact_round_trip(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from propval.sources.artifacts import load_artifact, save_artifact
    d = fx.listings(spark, sf).select("bedrooms", "full_baths", F.col("price")).dropna()
    model = Pipeline(stages=[VectorAssembler(inputCols=["bedrooms", "full_baths"], outputCol="features"),
                             LinearRegression(labelCol="price")]).fit(d)
    path = output_dir(spark, "artifact")
    save_artifact(spark, path, model, {"feature_names": ["bedrooms", "full_baths"], "leaky": ["assessed_year"]})
    m2, meta = load_artifact(spark, path)
    assert meta["feature_names"] == ["bedrooms", "full_baths"]
    a = model.transform(d).select("prediction").collect()
    b = m2.transform(d).select("prediction").collect()
    assert a == b
