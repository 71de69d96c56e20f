import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from propval.llm import hmm, langid, queries

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(rows, parts=5):
    """(n_tokens, n_known, N, base_score) of each (doc_id, text)."""
    words = [WORD.findall((t or "").translate(LOWER)) for _, t in rows]
    learn = [d is None or zlib.crc32(str(d).encode()) % parts != 1 for d, _ in rows]
    c = Counter(w for ws, x in zip(words, learn) if x for w in ws)
    ends = sum(learn)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    den = math.log10(n + 0.5 * (v + 1))
    return [(len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), n, sum(math.log10(c[w] + 0.5) - den for w in ws) + math.log10(ends + 0.5) - den) for ws in words]


def check(rows, got):
    want = sorted(((str(d), *b) for (d, _), b in zip(rows, base(rows))), key=str)
    got = sorted(((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    assert len(want) == len(got)
    for a, b in zip(want, got):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)


def test_counts_base_score_and_gain_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op4_hmm_lm"](spark, sf).collect()
    check(rows, got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_join_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(hmm, "TOP_WORDS", 3)
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(i % 40))) for i in range(60)] + [
        (3, None), (None, "W1 w2 Ä"), (None, "W1 w2 Ä"), (7, "w1 w99"), (7, "w1 w99"), (70, ""), (71, "new words only"), (72, "w1 w2 " * 5000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string").repartition(3)
    got = hmm.score(df, langid.held_out("doc_id", 5)).collect()
    check(rows, got)
    assert all(math.isfinite(r.score) for r in got)


def test_no_training_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = hmm.score(df, F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score)
    assert hmm.score(df.limit(0), F.lit(False)).count() == 0


def brute_forward(m, seq):
    a, log = m.start * m.emit[seq[0]], 0.0
    for c in seq[1:]:
        a = (a @ m.move) * m.emit[c]
        log, a = log + math.log10(a.sum()), a / a.sum()
    return log + math.log10(a.sum())


def random_model(rng, classes, states=hmm.STATES):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((classes, states)), 0))


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(1)
    m = random_model(rng, 5)
    lengths = [1, 2, 63, 64, 65, 128, 200, 1, hmm.LONG, hmm.LONG + 1, 5000, 4]
    seqs = [rng.integers(0, 5, n) for n in lengths]
    got = hmm.log10_likelihood(m, np.concatenate(seqs).astype(np.uint16), np.concatenate([[0], np.cumsum(lengths)]))
    assert np.allclose(got, [brute_forward(m, s) for s in seqs], rtol=1e-12)


def test_expected_counts_match_enumeration():
    rng = np.random.default_rng(2)
    m = random_model(rng, 3, 2)
    seq = [0, 2, 1, 1]
    emit, move, start = np.zeros((3, 2)), np.zeros((2, 2)), np.zeros(2)
    hmm.expected(m, np.array(seq, np.uint16), np.array([0, 4]), emit, move, start)
    e, t, s, total = np.zeros((3, 2)), np.zeros((2, 2)), np.zeros(2), 0
    for path in np.ndindex(2, 2, 2, 2):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for i in range(1, 4):
            p *= m.move[path[i - 1], path[i]] * m.emit[seq[i], path[i]]
        total += p
        s[path[0]] += p
        for i in range(4):
            e[seq[i], path[i]] += p
        for i in range(1, 4):
            t[path[i - 1], path[i]] += p
    assert np.allclose(emit, e / total, atol=1e-6) and np.allclose(move, t / total, atol=1e-6) and np.allclose(start, s / total, atol=1e-6)


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(i, f"a b c{i % 5}") for i in range(30)], "doc_id long, text string")
    _, v = hmm.vocabulary(df)
    encoded = hmm.encode(df.selectExpr("doc_id", "false held_out", "xxhash64(text) text_hash", "text"), v)
    m = hmm.train(encoded, v)
    assert np.allclose(m.emit.sum(axis=0), 1) and np.allclose(m.move.sum(axis=1), 1)


def test_every_training_document_shapes_the_states(spark, monkeypatch):
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * k + k * k) % 30}" for k in range(40))) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _, v = hmm.vocabulary(df)
    encoded = hmm.encode(df.selectExpr("doc_id", "false held_out", "xxhash64(text) text_hash", "text"), v).cache()
    seen, logs, own = [], [], hmm.baum_welch

    def counted(encoded, v, model):
        seen.append(encoded.count())
        out, log = own(encoded, v, model)
        logs.append(log)
        return out, log
    monkeypatch.setattr(hmm, "baum_welch", counted)
    hmm.train(encoded, v)
    assert set(seen) == {900} and len(logs) > 2                       # no iteration sees less than all
    assert all(b > a for a, b in zip(logs[:-2], logs[1:])) and logs[-1] - logs[-2] <= hmm.SETTLED * abs(logs[-1])
    emit = hmm.first_states(encoded, v).emit
    assert (emit.std(axis=1) > 1e-3 * emit.mean(axis=1)).any()        # the states differ from the start


def test_score_is_the_forward_probability_of_the_words(spark, monkeypatch):
    """score of whole texts against a recursion over words: a class' emission,
    times the word's smoothed share of its class."""
    monkeypatch.setattr(hmm, "TOP_WORDS", 12)
    rows = [(i, " ".join(f"w{(i * k + k * k) % 41}" for k in range(1, 5 + i % 70))) for i in range(120)] + [(500, "new words"), (501, ""), (502, None), (503, "w1 " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept, own = [], hmm.train
    monkeypatch.setattr(hmm, "train", lambda encoded, v: kept.append((own(encoded, v), v)) or kept[0][0])
    got = {r.doc_id: r.score for r in hmm.score(df, langid.held_out("doc_id", 5)).collect()}
    model, v = kept[0]
    c = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in WORD.findall(t or ""))

    def of(word):
        part = hmm.pa.array([word])
        cls, top = hmm._classes(hmm._tokens(part)[0], v)
        if top[0]:
            return int(cls[0]), 0.0
        b = int(cls[0]) - len(v.words)
        return int(cls[0]), math.log10(c[word] + 0.5) - math.log10(v.bucket_tokens[b] + 0.5 * (v.bucket_words[b] + 1))
    for i, t in rows:
        seq = [of(w) for w in WORD.findall(t or "")] + [(v.end, 0.0)]
        assert math.isclose(got[i], brute_forward(model, [x for x, _ in seq]) + sum(x for _, x in seq), rel_tol=1e-9)
