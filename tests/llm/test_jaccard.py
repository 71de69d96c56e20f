"""The metric-space join against all pairs."""

import re

import pytest

from propval.llm import jaccard, queries

WORD = re.compile("[^\x20\x09-\x0D]+")


def sets_of(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute(rows):
    sets, parent = [sets_of(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return sorted(((d, len(sets[i]), best.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(df).collect()), key=str)


@pytest.mark.parametrize("leaf", [2048, 8])
def test_matches_all_pairs(spark, rng, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", 3)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(40, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
            base = copy if rng.random() < 0.3 else base          # chains
    texts += ["", " \n", None, "one", "One", "one two", "ONE  two", "ÄB c d", "äB c d", texts[3].upper(), texts[3], texts[3] + " tail"]
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "lonely words here"), (5, "another text with id five"), (5, texts[0])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df) == brute(rows)


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in queries.QUERIES["op6_jaccard_join"](spark, sf).collect()), key=str)
    assert got == brute(rows)


def test_one_of_each_and_clashing_columns(spark):
    rows = [(3, "a b c d", 1, "x"), (2, "A b c d", 2, "y"), (2, "A b c d", 2, "y"), (9, "", 0, "z"), (9, "", 0, "z"), (None, "q r s", 0, "n"), (None, "q r s", 0, "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, class string")
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(map(tuple, kept.collect()), key=str)
    assert [r for r in got if r[1]][:1] == [(2, "A b c d", 2, "y")] and len([r for r in got if r[0] is None]) == 1 and len(got) == 4
    assert jaccard.join(df.limit(0)).count() == 0


def test_null_and_repeated_ids_give_each_set_once(spark, rng, monkeypatch):
    def text(n):
        return " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    hot = text(60)
    rows = [(None, text(40)) for _ in range(200)] + [(None, hot)] * 150 + [(7, text(30)) for _ in range(50)] + [(8, hot + " more")]
    sizes, kept = [], jaccard.written

    def counted(df):
        out = kept(df)
        if "shingles" in out.columns:
            sizes.append((out.count(), out.select("class").distinct().count()))
        return out
    monkeypatch.setattr(jaccard, "written", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.join(df).collect()
    classes = {r["class"] for r in got}
    assert len(sizes) == 1 and sizes[0][0] == sizes[0][1] >= 2 and len(classes) == 252 and len(got) == len(rows)
    assert sum(r.component_id == 8 for r in got) == 151 and len({r.component for r in got}) == 251
