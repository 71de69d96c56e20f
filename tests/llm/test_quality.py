import re
from collections import Counter

from propval.llm import quality, queries

WORD = re.compile("[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text or ""), again, len(inside))


def shares(text):
    """Shares of word characters inside n-grams that repeat an earlier one."""
    w, out = WORD.findall(text or ""), []
    for n in quality.NGRAM_SHARE:
        seen, marked = set(), set()
        for i in range(len(w) - n + 1):
            g = tuple(w[i:i + n])
            if g in seen:
                marked |= set(range(i, i + n))
            seen.add(g)
        out.append(sum(len(w[i]) for i in marked) / max(1, sum(map(len, w))))
    return out


def check(rows, got):
    assert sorted(map(str, (r[0] for r in rows))) == sorted(str(r.doc_id) for r in got)
    for text, r in ((dict((str(d), t) for d, t in rows)[str(r.doc_id)], r) for r in got):
        b = base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        s = shares(text)
        for n, x in zip(quality.NGRAM_SHARE, s):
            assert abs(r[f"dup_{n}gram_share"] - x) < 1e-9
        if r.base_failed:
            assert not r.kept


def test_edge_rows(spark, rng):
    phrase = " ".join(f"p{i}" for i in range(14))
    clean = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, clean), (5, f"{clean}\n{phrase}\n{phrase}\n\n{phrase}"), (6, "é ü " * 40), (7, "x" * 300_000),
            (8, "a b c " * 60_000), (9, clean + " ### $$ " * 30), (10, "nbsp one 　 two"), (None, clean)] + [
        (100 + i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 90))).replace("aa", "\n")) for i in range(40)]
    got = quality.quality(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, N_words string").repartition(3)).collect()
    check(rows, got)
    kept = {r.doc_id for r in got if r.kept}
    assert 4 in kept and None in kept and not kept & {1, 2, 3, 6, 7, 8, 9}


def test_a_passage_repeated_within_a_text(spark):
    own = " ".join(f"own{i}" for i in range(120))
    passage = lambda n: " ".join(f"pas{i}" for i in range(n))
    rows = [(1, own), (2, f"{own} {passage(40)} and {passage(40)}"), (3, f"{own} {passage(30)} and {passage(30)} or {passage(30)}"), (4, f"{own} {passage(12)} and {passage(12)}")]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    check(rows, list(got.values()))
    assert not any(r.base_failed for r in got.values())
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, False, True]


def test_empty_table_and_kept_rows(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(1, clean, 3), (1, clean, 3), (2, "short", 4)], "doc_id long, text string, kept int")
    assert quality.quality(df.limit(0)).count() == 0
    kept = quality.kept_rows(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, clean, 3)] * 2


def test_query_on_documents_keeps_good_ones(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op7_quality_rules"](spark, sf).collect()
    check(rows, got)
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.kept for r in got if good.get(r.doc_id) == 1 and not r.base_failed)
    assert not any(r.kept for r in got if good.get(r.doc_id) == 0)
