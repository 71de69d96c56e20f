import re

from hypothesis import given, settings
from hypothesis import strategies as st

from propval.llm import licenses, queries


@given(st.lists(st.integers(0, 30), max_size=60))
@settings(max_examples=60, deadline=None)
def test_rising_is_longest(values):
    at = licenses.rising(values)
    assert all(values[a] < values[b] and a < b for a, b in zip(at, at[1:]))
    best = []
    for i, v in enumerate(values):
        best.append(1 + max((best[j] for j in range(i) if values[j] < v), default=0))
    assert len(at) == max(best, default=0)


@given(st.lists(st.integers(0, 12), max_size=40), st.lists(st.integers(0, 12), max_size=40))
@settings(max_examples=100, deadline=None)
def test_alignment_is_a_common_subsequence(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(licenses.align(a, a)) == len(a)


def found(spark, rows, templates=None):
    return licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()


def test_notices_in_texts(spark):
    mit, apache = licenses.TEMPLATES["MIT-notice"], licenses.TEMPLATES["Apache-2.0-header"]
    edited = mit.replace("to deal in the Software", "to use it").replace("sublicense, ", "")
    rows = [(1, f"Start of a file. {mit} The code."), (2, edited.upper()), (3, f"{apache} {apache}"), (4, "plain text under the license of a version"),
            (5, None), (6, ""), (7, " ".join(mit.split()[::-1])), (8, "filler words " * 50_000 + mit), (None, mit), (1, f"Start of a file. {mit} The code.")]
    got = found(spark, rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.license for r in by[1]] == ["MIT-notice"] * 2 and by[1][0].coverage == 1.0 and by[1][0].first_word == 4
    assert by[2][0].license == "MIT-notice" and 0.85 < by[2][0].coverage < 1
    assert sum(r.license == "Apache-2.0-header" and r.coverage == 1.0 for r in by[3]) == 2
    assert not set(by) & {4, 5, 6, 7} and by[None][0].coverage == 1.0
    assert by[8][0].first_word == 100_000


def test_empty_table_extra_columns_no_templates(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.", "x")], "doc_id long, text string, license string")
    assert licenses.scan(df).first().license == "MIT"
    assert licenses.scan(df.limit(0)).count() == 0
    assert licenses.scan(df, {}).count() == 0


def test_query_finds_every_grant_line(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.license) for r in queries.QUERIES["op5_license_scan"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    norm = lambda s: " ".join(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", s)).lower()
    want = {(d.doc_id, name) for d in docs for name, t in licenses.TEMPLATES.items() if f" {norm(t)} " in f" {norm(d.text)} "}
    assert want and want <= got
    assert {d for d, _ in got} == {d for d, _ in want}


def test_siblings_are_told_apart(spark):
    lesser = licenses.TEMPLATES["GPL-3.0-header"].replace("GNU General", "GNU Lesser General")
    grants = {"Licensed under CC BY 4.0": "CC-BY-4.0", "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0", "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0",
              "This work is licensed under a Creative Commons Attribution 4.0 International License": "CC-BY-4.0-work",
              "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
              "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
              "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
              "This work is licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0",
              "the GNU Lesser General Public License, version 3": "LGPL-3.0-name",
              "This work is licensed under the GNU Affero General Public License, version 3": "AGPL-3.0", lesser: "LGPL-3.0-header",
              "Licensed under the Mozilla Public License, Version 2.0": "MPL-2.0", "Licensed under the Apache License, Version 2.0": "Apache-2.0",
              "Licensed under CC0 1.0": "CC0-1.0", "Released under the Unlicense": "Unlicense-grant", "Released under the MIT License": "MIT",
              licenses.TEMPLATES["BSD-2-Clause"]: "BSD-2-Clause", licenses.TEMPLATES["Apache-2.0-header"]: "Apache-2.0-header"}
    rows = [(i, f"Some words of a page. {text} More words follow.") for i, text in enumerate(grants)]
    third = "3. Neither the name of Example Corp nor the names of its contributors may be used to endorse or promote products derived from this software"
    rows.append((99, licenses.TEMPLATES["BSD-2-Clause"] + " " + third + " without specific prior written permission."))
    got = sorted((r.doc_id, r.license) for r in found(spark, rows))
    assert got == sorted([*enumerate(grants.values()), (99, "BSD-3-Clause")])
