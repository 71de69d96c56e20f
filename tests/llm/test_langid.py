import zlib

from propval.llm import langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, len(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_language_id"](spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) / len(held) > 0.98
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held if truth[r.doc_id][1] > 200) / sum(truth[r.doc_id][1] > 200 for r in held) > 0.99


def test_edge_rows(spark):
    labelled = spark.createDataFrame([("the cat and the dog " * 5, "en"), ("le chat et le chien " * 5, "fr"), ("x", None), (None, "en"), ("1 2", "de")] * 3, "text string, lang string")
    net = langid.fit(labelled)
    assert net.langs == ["en", "fr"]
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "12 34 !", "c"), (4, "the dog", "d"), (4, "the dog", "d"), (None, "le chien", "e"), (5, "the cat " * 100_000, "f")],
                               "doc_id long, text string, SCORE string")
    out = langid.identify(df, net).collect()
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[3].score == 0
    assert len(out) == 7 and by[4].lang_pred == "en" and by[None].lang_pred == "fr" and by[5].lang_pred == "en"
    assert langid.identify(df.limit(0), net).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.fit(df) is None
    assert langid.identify(df, None).first().lang_pred == "und"


def test_same_rows_same_network(spark):
    rows = [(f"word{i} number{i * 7} text", "ab"[i % 2]) for i in range(60)]
    a = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    b = langid.fit(spark.createDataFrame(rows[::-1], "text string, lang string").repartition(5))
    assert (a.out == b.out).all() and (a.embed == b.embed).all()
