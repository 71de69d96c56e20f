import html
import html.parser
import re
import time

import pytest

from propval.llm import queries, render

CASES = [
    ("<p>one<p>two <b>b</b>\n x<ul><li>a<li>b<ul><li>c</ul><li>d</ul>tail", "one\n\ntwo b x\n\n- a\n- b\n  - c\n- d\n\ntail"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td rowspan=2>x<td>1<tr><td>22</table>after", "Name  | Qty\napple | 3\nx     | 1\n      | 22\n\nafter"),
    ("<table><caption>Cap</caption><tr><td colspan=2>wide cell<td>c<tr><td>a<td>b<td>c</table>", "Cap\nwide cell |   | c\na         | b | c"),
    ("<ol start=3><li>a<li>b</ol>", "3. a\n4. b"),
    ("<pre>  x\n   y\n\nz</pre>t", "  x\n   y\n\nz\n\nt"),
    ("<div hidden>no</div><div style='display: none'>no</div>yes<br>z<script>x<p></script><!-- c > -->", "yes\nz"),
    ("a<span style='visibility:hidden'>h<i style='visibility:visible'>v</i></span>", "av"),
    ("<details><summary>S</summary>hid<p>hid</details><details open><summary>T</summary>seen</details>", "S\nT\nseen"),
    ("<html><head><title>T</title><style>p{}</style><body><h1>H</h1>x &amp; y &lt;z&gt;", "H\n\nx & y <z>"),
    ("<head><meta charset=utf-8>text ends head", "text ends head"),
    ("<table><tr><td><p>one<p>two<td>r</table>", "one | r\n    |\ntwo |"),
    ("<a href='x>y'>l</a> <p class=\"unclosed", "l"), ("<!-- open", ""), ("", ""), (None, ""), ("no tags  at\nall", "no tags at all"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"), ("a<hr>b", "a\n\n---\n\nb"), ("<select><option>x<option>y</select>", "x\ny"),
    ("a</p>b</div></b>c<p>d", "abc\n\nd"), ("x < y <3", "x < y <3"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_cases(page, text):
    assert render.render(page)[0] == text


def test_deep_and_long_pages():
    assert render.render("<div>" * 100_000 + "deep")[0] == "deep"
    assert render.render("<ul><li>" * 5_000 + "deep")[0].endswith("deep")
    assert render.render('<a x="' * 20_000)[0] == ""
    assert render.render("<p>" + "word " * 200_000)[0].count("word") == 200_000
    assert render.render("<table>" + "<tr><td>a<td>b" * 5000)[2] == 10_000


class Visible(html.parser.HTMLParser):
    """Words outside of script, style, head and title, by another parser."""

    def __init__(self):
        super().__init__()
        self.hidden, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head", "title", "noscript", "template")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head", "title", "noscript", "template")

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def test_all_visible_words_of_the_pages(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.QUERIES["op8_html_rendering"](spark, sf).collect()
    assert {r.page_id for r in rows} == set(pages) and len(rows) == len(pages)
    squeeze = lambda s: re.sub(r"\s+", "", s)
    for r in rows:
        p = Visible()
        p.feed(pages[r.page_id])
        own = re.sub(r"(?m)^(?: *- )+", "", r.rendered).replace(" | ", "")
        want = squeeze("".join(p.words)).replace("|", "")
        assert squeeze(own).replace("|", "") == want or r.n_cells or "<ol" in pages[r.page_id]


def test_null_rows_empty_table_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "<p>x", 6), (None, "", 7)], "page_id long, html string, n_chars int")
    assert sorted((str(r.page_id), r.rendered, r.n_chars) for r in render.render_pages(df).collect()) == [("1", "", 0), ("1", "x", 1), ("None", "", 0)]
    assert render.render_pages(df.limit(0)).count() == 0


def test_large_tables_and_spans_stay_linear():
    began = time.process_time()
    text, _, cells = render.render("<table><tr>" + "".join(f"<td>c{i}" for i in range(20_000)) + "</table>")
    assert cells == 20_000 and text.split(" | ") == [f"c{i}" for i in range(20_000)]
    many = "<table>" + "".join(f"<tr><td rowspan=60000>r{i}" for i in range(2_000)) + "</table>end"
    text, _, cells = render.render(many)
    assert cells == 2_000 and text.split() == [f"r{i}" for i in range(2_000)] + ["end"] and len(text) < len(many)
    wide = "<table><tr>" + "".join(f"<td colspan=1000>w{i}" for i in range(200)) + "</table>"
    assert render.render(wide)[0].split(" | ") == [f"w{i}" for i in range(200)]
    tall = "<table><tr>" + "<td>x" * 500 + "<td>" + "<br>".join(f"l{i}" for i in range(5_000)) + "</table>"
    assert len(render.render(tall)[0]) < len(tall) and render.render(tall)[0].split() == ["x"] * 500 + [f"l{i}" for i in range(5_000)]
    assert time.process_time() - began < 5


def test_spans_that_overlap_and_end():
    page = "<table><tr><td>a<td rowspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g<td>h</table>"
    assert render.render(page)[0] == "a | b | c\nd |   | e\nf | g | h"
    assert render.render("<table><tr><td rowspan=3 colspan=2>a<td>b<tr><td>c<tr><td>d<tr><td>e<td>f<td>g</table>")[0] == "a |   | b\n  |   | c\n  |   | d\ne | f | g"
