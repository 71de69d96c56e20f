"""Every stage of the pipeline against a brute-force version, on its own input."""

import __spark_entry__ as entry
import corpus_pipeline
import pyarrow as pa
import test_jaccard
import test_mixing
import test_suffixes
from propval.llm import quality
from propval.llm.store import written
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "mixing sources to target weights"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = written(stage(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = sorted(tuple(r) for r in docs.collect())
        if name == "quality rules":
            kept = quality.measure(pa.array([r[1] for r in before], pa.string()))[-1]
            assert after == sorted(r for r, k in zip(before, kept) if k)
        elif name == "n-gram Jaccard join":
            component = {d: c for d, _, c in test_jaccard.brute([r[:2] for r in before])}
            assert after == sorted(r for r in before if component[r[0]] == r[0])
        elif name == "suffix-array dedup":
            want = test_suffixes.brute([r[:2] for r in before])
            assert {r[0] for r in after} == {d for (d, t), v in want.items() if v[0] > v[1] and test_jaccard.WORD.search(kept_of(before, d))}
            assert [r[1] for r in after] == [kept_of(before, r[0]) for r in after] and all(r[4] == len(r[1]) for r in after)
        else:
            assert after == sorted(r for r in before if not any(x in r[1] for x in items))
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {(r.doc_id, r.text) for r in mixed} <= {(r[0], r[2]) for r in rows} and all(0 < r.taken <= 3 * r["size"] for r in mixed)
    own, taken = {}, {}
    for _, s, t in rows:
        own[s] = own.get(s, 0) + len(test_jaccard.WORD.findall(t))
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in test_mixing.mixing.targets(list(own.items())).items():
        assert abs(taken.get(s, 0) - n) <= 2 * test_mixing.mixing.BLOCK_WORDS


def kept_of(rows, doc_id, cache={}):  # noqa: B006
    key = len(rows)
    if key not in cache:
        seen, cache[key] = set(), {}
        for d, t in sorted((r[0], r[1]) for r in rows):
            b = t.encode()
            gone = bytearray(len(b))
            for p in range(len(b) - 99):
                if b[p:p + 100] in seen:
                    gone[p:p + 100] = b"\1" * 100
                seen.add(b[p:p + 100])
            cache[key][d] = bytes(x for x, g in zip(b, gone) if not g).decode(errors="ignore")
    return cache[key][doc_id]


def test_edge_rows_pass_every_stage(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    rows = [(1, clean, "en", "a", 5, 1), (2, clean, None, None, 5, 2), (None, clean + " tail", "en", "a", 6, 3), (None, None, None, None, None, None),
            (4, "", "en", "b", 0, 4), (5, "short", "en", "b", 5, 5), (1, clean, "en", "a", 5, 1), (7, " ".join(f"x{i}" for i in range(60_000)), "en", "c", 9, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, taken int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = written(stage(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "taken"]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in out.collect()} == {1, 7}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
    assert names["pipeline"](spark, SF).agg(F.count("*")).first()[0] > 0
