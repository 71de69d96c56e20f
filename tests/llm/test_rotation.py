import duckdb
import pytest

from propval.llm import queries, rotation

TURNS = [(1, 0, "system", "Be kind."), (1, 1, "ann", "hi <|end|> there"), (1, 2, "bob", "é"), (1, 2, "bob", "é"), (1, None, "ann", None), (1, 70, None, "late"),
         (2, 0, "system", "alone"), (3, 0, "", "no name"), (None, 1, "x", "null conversation"), (None, 0, "y<|", "first"), (4, -5, "a", "negative")] + [
        (5, i // 2, "abc"[i % 3], f"turn {i}") for i in range(300)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


def reference(rows):
    convs, out = {}, {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is None, t if t is not None else 0, r is not None, r or "", x is not None, x or ""))
    for c, turns in convs.items():
        turns.sort()
        named = [(r or "unknown", x.replace("<|", "< |")) for _, _, _, r, _, x in turns]
        for p in {s for s, _ in named} - {"system"}:
            for part in range(0, len(named), rotation.PART_TURNS):
                text, mask = "", []
                for s, x in named[part:part + rotation.PART_TURNS]:
                    text += "<|system|>\n" if s == "system" else "<|assistant|>\n" if s == p else f"<|user:{s.replace('<|', '< |')}|>\n"
                    if s == p:
                        mask.append((len(text), len(text) + len(x) + 7))
                    text += x + "<|end|>\n"
                out[c, p, part // rotation.PART_TURNS] = (text, mask)
    return out


def test_matches_reference(spark):
    got = {(r.conv_id, r.perspective, r.part): (r.rendered, [tuple(m) for m in r["mask"]]) for r in rotation.rotate(frame(spark, TURNS).repartition(3)).collect()}
    assert got == reference(TURNS)
    for text, mask in got.values():
        assert all(text[a:b].endswith("<|end|>") for a, b in mask)


def test_oracle_on_edge_rows_and_documents(spark):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn int, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", TURNS)
    want = sorted(map(str, con.execute(rotation.ORACLE).fetchall()))
    assert sorted(str(tuple(r)) for r in rotation.digest(rotation.rotate(frame(spark, TURNS))).collect()) == want
    sf = "/root/testdata/sf0.001"
    con.execute(f"create or replace table conversations as select * from '{sf}/conversations.parquet'")
    got = queries.QUERIES["op3_perspective_rotation"](spark, sf)
    assert got.columns == [d[0] for d in con.execute(queries.ORACLES["op3_perspective_rotation"]).description]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, con.execute(rotation.ORACLE).fetchall()))


@pytest.mark.parametrize("extra", ["c string", "speaker string"])
def test_empty_table_and_extra_columns(spark, extra):
    df = spark.createDataFrame([(1, 0, "a", "t", "z")], f"conv_id long, turn int, role string, text string, {extra}")
    assert rotation.rotate(df).count() == 1
    assert rotation.rotate(df.limit(0)).count() == 0
