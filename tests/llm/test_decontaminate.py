"""Template decontamination: planted copies, re-parameterised copies, clean text."""

from propval.llm import decontaminate, queries

ITEM = "Ann has 12 apples and gives Bob 3 apples each day. How many apples are left after Ann meets Bob for 2 days in the old market hall?"


def run(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(df, bench).collect()}


def test_kinds_slots_and_clean_documents(spark):
    other = ITEM.replace("Ann", "Zoe").replace("Bob", "Max").replace("12", "40").replace("3 apples", "7 apples").replace("2 days", "5 days")
    names = "we know that Bob really likes when Bob often meets with Bob near the river and Bob said that Bob came to the old stone bridge"
    crossed = names
    for name in ("Tim", "Kim", "Jim", "Lim", "Sam"):
        crossed = crossed.replace("Bob", name, 1)
    docs = [(1, "Some words before. " + ITEM + " Some words after."), (2, "Before. " + other), (3, "clean prose about apples and markets " * 30),
            (4, ITEM.upper()), (5, " ".join(ITEM.split()[:10])), (6, None), (7, ""), (8, "12 3 4 5 6 7 8 9 10 11 12 13 14 15 16 " * 10),
            (None, ITEM), (1, "Some words before. " + ITEM + " Some words after."), (9, "word " * 100_000 + ITEM), (10, crossed), (11, names.replace("Bob", "Tim"))]
    got = run(spark, docs, [(100, ITEM), (101, "short one here"), (102, None), (103, ""), (104, "exactly five plain words here"), (105, ITEM), (106, names)])
    assert {(1, 100), (2, 100), (9, 100), (None, 100), (1, 105), (11, 106)} <= set(got)
    assert got[1, 100].kind == "exact" and got[2, 100].kind == "template" and got[2, 100].agreeing == 1.0 and got[2, 100].n_changed > 2
    assert not {d for d, _ in got} & {3, 5, 6, 7, 8, 10}
    assert not {i for _, i in got} & {101, 102, 103, 104}


def test_short_items_match_whole(spark):
    got = run(spark, [(1, "here are exactly five plain words today"), (2, "exactly five plain other words")], [(7, "Exactly five plain words today!"), (8, "too short")])
    assert set(got) == {(1, 7)}


def test_verbatim_copies_of_dense_items(spark):
    numbers = "Find the sum of 12, 15, 18, 21 and 30."
    edges = "Put 3 4 5 6 7 8 on the first line of the page"
    docs = [(1, "Exercise one. " + numbers + " Then stop."), (2, numbers.lower()), (3, "Find the sum of 13, 16, 19, 22 and 31."),
            (4, "Before. " + edges + " and go on"), (5, "Find the sum of 12, 15, 18, 21 and 31.")]
    got = run(spark, docs, [(100, numbers), (101, edges)])
    assert set(got) == {(1, 100), (2, 100), (3, 100), (5, 100), (4, 101)}
    assert got[1, 100].kind == "exact" and got[1, 100].covered == 10 and got[1, 100].n_changed == 0
    assert got[3, 100].kind == "template" and got[3, 100].n_changed == 5 and got[5, 100].n_changed == 1


def test_dense_word_problems_with_other_numbers(spark):
    train = "A train travels 60 km in 2 hours and then 90 km in 3 hours, find the mean speed."
    other = train.replace("60", "50").replace("in 2", "in 4").replace("90", "80").replace("in 3", "in 5")
    docs = [(1, "Solve this. " + other + " Show your work."), (2, train), (3, "A train travels 50 km in 4 hours and then 80 km in 5 hours, so we went home by bus."),
            (4, "They ran 50 km in 4 hours and then 80 km in 5 hours and found the mean street."), (5, "3 km 4 km 5 km 6 km 7 km 8 km 9 km 10 km 11 km 12 km")]
    got = run(spark, docs, [(100, train), (101, "21 km 22 km 23 km 24 km 25 km 26 km 27 km 28 km 29 km 30 km")])
    assert set(got) == {(1, 100), (2, 100)}
    assert got[1, 100].kind == "template" and got[1, 100].covered == 19 and got[1, 100].n_changed == 4 and got[1, 100].agreeing == 1.0
    assert got[2, 100].kind == "exact"


def test_short_items_inside_sentences(spark):
    tall, apples, plain = "What is the tallest mountain in the whole world", "Ann has 12 apples in the old hall", "Where do most people live"
    docs = [(1, "Yesterday they asked us " + tall + " and we knew"), (2, "yes, and so Zoe has 40 apples in the old hall today"), (3, "they asked us " + plain + " now"),
            (4, "we say that what is the tallest mountain is known in the whole world"), (5, "in the end " + tall.lower())]
    got = run(spark, docs, [(100, tall), (101, apples), (102, plain)])
    assert set(got) == {(1, 100), (2, 101), (3, 102), (5, 100)}
    assert got[1, 100].kind == got[3, 102].kind == "exact" and got[2, 101].kind == "template"


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_extra_columns(spark):
    docs = spark.createDataFrame([(1, ITEM, 5, "x")], "doc_id long, text string, item_id int, key string")
    items = spark.createDataFrame([(2, ITEM, 6, "y")], "item_id long, text string, doc_id int, place string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()] == [(1, 2)]


def test_query_finds_every_whole_item(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op1_decontamination"](spark, sf).collect()}
    assert want == got


OPENING = "Which one of the following statements about the subject below is"      # 11 words


def _windows(spark, docs, items):
    keyed = decontaminate._keyed(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    own = keyed.mapInArrow(decontaminate._benchmark, decontaminate.WINDOWS).cache()
    keyed = decontaminate._keyed(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    return keyed.mapInArrow(decontaminate._benchmark, decontaminate.WINDOWS), own


def test_common_openings_join_no_pairs(spark):
    def own_words(i):
        name = "".join(chr(97 + int(c)) for c in str(i))
        return " ".join(f"w{name}{c}" for c in "klmnopqrst")
    items = [(i, f"{OPENING} {own_words(i)}") for i in range(200)]
    docs = [(d, f"{OPENING} {own_words(1000 + d)}") for d in range(300)] + [(5000, items[7][1]), (5001, "So " + items[8][1])]
    found, own = _windows(spark, docs, items)
    shared = found.select("key").join(own.select("key"), "key").count()
    seeds = decontaminate._seeds(found, own)
    assert shared > 200 * 300 * 4                                     # what a join of windows alone would make
    assert {(r.doc_id, r.item_id, r.diagonal) for r in seeds.collect()} == {(5000, 7, 0), (5001, 8, 1)}
    assert set(run(spark, docs, items)) == {(5000, 7), (5001, 8)}


def test_seeds_lose_no_run(spark):
    import random
    rnd = random.Random(5)
    words = ["the", "river", "stone", "old", "12", "7", "km", "Ann", "Bob", "market", "sees", "and"]

    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, text(rnd.randint(5, 30))) for i in range(60)]
    docs = []
    for d in range(260):
        src = rnd.choice(items)[1].split()
        for _ in range(rnd.randint(0, 3)):
            src[rnd.randrange(len(src))] = rnd.choice(words)
        cut = rnd.randint(0, 4)
        docs.append((d, " ".join([text(rnd.randint(0, 9)), *src[cut:], text(rnd.randint(0, 9))])))
    items += [(None, items[3][1]), (4, items[5][1])]
    docs += [(None, docs[2][1]), (None, docs[3][1]), docs[4], (5, docs[6][1])]
    got = {(r.doc_id, r.item_id, r.covered, r.kind) for r in decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}

    def every_pair(found, own):
        """All common windows of all pairs, without seeds."""
        from pyspark.sql import functions as F
        i = own.select("key", F.col("id").alias("item_id"), F.col("text_hash").alias("i_hash"), F.col("place").alias("i_place"),
                       F.col("words").alias("item_words"), F.col("slots").alias("item_slots"))
        return (found.join(i, "key").withColumn("doc_id", F.col("id")).withColumn("diagonal", F.col("place") - F.col("i_place")))
    kept = decontaminate._matched
    decontaminate._matched = every_pair
    try:
        want = {(r.doc_id, r.item_id, r.covered, r.kind) for r in decontaminate.contaminated(
            spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    finally:
        decontaminate._matched = kept
    assert got == want and len(want) > 60 and {k for *_, k in want} == {"exact", "template"}
