import random
import re
from collections import Counter

from propval.llm import collocations as co
from propval.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    drop = {(lang, w[i:i + m]) for (lang, w), b in cand.items() for m in range(2, len(w)) for i in range(len(w) - m + 1)
            if 100 * b >= 80 * f[lang, w[i:i + m]]}
    out = []
    for lang in n:
        own = []
        for (at, w), a in cand.items():
            if at == lang and (at, w) not in drop:
                s, k = min((2000000 * a // (f[at, w[:k]] + f[at, w[k:]]), k) for k in range(1, len(w)))
                own.append((-s, -a, " ".join(w).encode(), f[at, w[:k]], f[at, w[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(own)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def texts(n=900):
    rng, rows = random.Random(3), []
    vocab = ["The", "the", "a", "é", "naïve", "x-1", "\"q\"", "ab", "aa", "a b", "#", "long" * 30]
    fixed = ["once upon a time in the west", "a a a a a a a", "New York City hall of fame and more words here", "end"]
    for i in range(n):
        words = [rng.choice(fixed if rng.random() < 0.3 else vocab) if rng.random() < 0.9 else f"w{rng.randrange(400)}" for _ in range(rng.randrange(30))]
        rows.append(("".join(w + rng.choice([" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\x0b", "!"]) for w in words), rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", "fr"), ("  ", None), ("one " * 3000, "en"), (" .,", "en")] + [("same text again here", "en")] * 40 + [("en de, de en", "de"), ("de en, en de en", "en")] * 40


def test_all_columns_against_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(*r, "x") for r in rows], "text string, lang string, phrase string").repartition(5)
    want = brute(rows)
    assert len(want) > 30 and any(len(p.split()) == 4 for _, _, p, *_ in want) and any(len(p.split()) == 2 for _, _, p, *_ in want)
    assert got(co.collocations(df)) == want
    assert got(co.collocations(df, least=300, top=3)) == brute(rows, 300, 3)


def test_cuts_change_nothing_and_neither_do_shared_counters(spark, monkeypatch):
    rows = texts(200)
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(co, "maybe_frequent", lambda texts, least, frequent: co.np.full(co.SLOTS // 8, 255, co.np.uint8))
    assert got(co.collocations(df)) == brute(rows)


def test_paths_are_maximal_and_hold_every_edge(spark):
    rows = [("p q r s t u v. x r s t u y", "en")] * 40 + [("r s t u", "en")]
    texts = spark.createDataFrame(rows, "text string, lang string").select("lang", "text")
    counts = co.flow(co.grams(texts, 30), 30)
    paths = sorted((" ".join(r.words), r.n) for r in co.compact(counts).collect())
    assert paths == [("p q r s t", 40), ("r s t u", 81), ("s t u v", 40), ("s t u y", 40), ("x r s t", 40)]
    long = [(" ".join(f"w{i}" for i in range(70)), "en")] * 31
    texts = spark.createDataFrame(long, "text string, lang string").select("lang", "text")
    assert [(" ".join(r.words), r.n) for r in co.compact(co.flow(co.grams(texts, 30), 30)).collect()] == [(long[0][0], 31)]


def test_empty_table_and_documents(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(empty).count() == 0
    sf = "/root/testdata/sf0.001"
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op13_collocations"](spark, sf)) == brute(rows)
