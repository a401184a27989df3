"""Rendering of pages: blocks, lists, tables, visibility and broken markup."""

from __future__ import annotations

import pytest

from perfwatch.llm.html_text import extract, text_of

CASES = {
    "<p>a<p>b<ul><li>x<li>y<ul><li>z</ul><li>w</ul>end": "a\n\nb\n\n- x\n- y\n  - z\n- w\n\nend",
    "<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>total</table>after": "Name       Qty\napple pie  3\ntotal\n\nafter",
    "<table><caption>C</caption><tbody><tr><td rowspan=2>A<td>b<tr><td>c</table>": "C\nA  b\n   c",
    "<table><td>a<td>b</table>": "a  b",
    "<table><tr><td>one<br>two<td>x<table><tr><td>i<td>j</table></table>": "one  x\ntwo\n     i  j",
    "<div hidden>no</div><span style='color:red; display : none'>no</span>yes": "yes",
    "a<script>var a='<p>x</p>'</script><style>p{}</style><!-- c --><template>t</template><noscript>n</noscript>b": "ab",
    "<head><title>T</title><meta charset=x><p>shown": "shown",
    "<html><head><title>T</title></head><body>x</body></html>": "x",
    "one<br>two<pre>  a\n   b</pre>three": "one\ntwo\n\n  a\n   b\n\nthree",
    "<ol start=3><li>a<li>b</ol><blockquote>q<p>r</blockquote>": "3. a\n4. b\n\n  q\n\n  r",
    "<h1>T</h1>  text   <b>bold</b> text<a href=x>link</a>": "T\n\ntext bold textlink",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "x &amp; y &lt;b&gt; &eacute;&#33;": "x & y <b> é!",
    "<img alt='a cat'><input type=hidden value=h><input type=submit value=Go>": "a catGo",
    "<q>said</q> <textarea> k \n l</textarea>": "“said”  k\n l",
    "<dialog>shut</dialog><dialog open>open</dialog>": "open",
    "plain text\nonly": "plain text only",
    "<a href='unclosed>text": "<a href='unclosed>text",
    "a < b and <3": "a < b and <3",
    "</p>x</div></li>": "x",
    "<p>a<div>b</div>c": "a\n\nb\nc",
    "<nav><ul><li><a>A</a></li></ul></nav><footer>&copy; F</footer>": "- A\n\n© F",
}


@pytest.mark.parametrize("page", CASES)
def test_rendering(page):
    assert text_of(page) == CASES[page]


def test_odd_pages_do_not_fail():
    assert text_of(None) == text_of("") == text_of("<!-- open") == ""
    assert text_of("<div>" * 20_000 + "deep") == "deep"
    assert text_of("<table><tr><td>" * 300 + "x").strip() == "x"
    assert text_of("<table><tr><td colspan=99999999 rowspan=-1>x</table>") == "x"
    assert len(text_of("<p>word " * 50_000).split()) == 50_000
    assert text_of("<" * 50_000 + "x").endswith("x")


def test_no_visible_word_is_lost_and_no_hidden_one_kept(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = extract(pages).collect()
    assert len(rows) == pages.count()
    import html
    import re

    source = {r.page_id: r.html for r in pages.collect()}
    for r in rows:
        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>|<style.*?</style>", "", source[r.page_id])
        words = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert sorted(re.sub(r"(?m)^\s*- ", "", r.text).split()) == sorted(w for w in words) or "hidden" in body or "display" in body
        assert "track(" not in r.text and r.n_lines == r.text.count("\n") + 1


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string, n_lines int"
    rows = [(1, "u", None, "x", 1), (None, None, "<p>a", "x", 1), (2, "u", "", "x", 1), (2, "u", "<p>b", "x", 1), (2, "u", "<p>b", "x", 1)]
    got = sorted((tuple(r) for r in extract(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (None, None, "a", 1), (2, "u", "", 0), (2, "u", "b", 1), (2, "u", "b", 1)], key=repr)
    assert extract(spark.createDataFrame([], schema)).collect() == []


FOREIGN = {
    "so <math><mi>x</mi> <mo>=</mo> <mn>3</mn></math> holds": "so x=3 holds",
    "<p>a <math display=block><mfrac><mn>1</mn><mn>2</mn></mfrac></math> b": "a\n1 2\nb",
    "<math><semantics><msup><mi>x</mi><mn>2</mn></msup><annotation encoding=tex>x^2</annotation></semantics><mphantom>no</mphantom></math>": "x 2",
    "<math><mtable><mtr><mtd>a</mtd><mtd>b</mtd></mtr><mtr><mtd>c</mtd><mtd>d</mtd></mtr></mtable></math>": "a b\nc d",
    "a<svg><title>t</title><desc>d</desc><defs><text>no</text></defs><metadata>m</metadata><path d='M0'/>raw<g><text x=1>Q1 <tspan>sales</tspan></text><text>Q2</text></g></svg>b": "a\nQ1 sales\nQ2\nb",
    "a<svg/>b<svg><rect/></svg>c": "abc",
    "<svg><foreignObject><p>in</p></foreignObject></svg>": "in",
    "Size: <select><option>S<option selected>M<option>L</select> only": "Size: M only",
    "<select><option disabled>pick<option>one<option>two</select>": "one",
    "<select><option selected hidden disabled>Choose</option><option>one</option></select>": "Choose",
    "<select><optgroup label=G disabled><option>a</optgroup><optgroup label=H><option label=Bee>b</select>": "Bee",
    "x<select multiple><optgroup label=G><option>a<option>b</optgroup><option hidden>c<option>d</select>y": "x\nG\na\nb\nd\ny",
    "<table><tr><td><select><option>one<option>two</select><td><math><mi>y</mi></math></table>": "one  y",
    "<select hidden><option>a</select><svg style='display:none'><text>n</text></svg>z": "z",
}


@pytest.mark.parametrize("page", FOREIGN)
def test_formulas_labels_and_options(page):
    assert text_of(page) == FOREIGN[page]


def test_deep_foreign_markup_does_not_fail():
    assert text_of("<svg>" + "<g>" * 20_000 + "<text>deep") == "deep"
    assert text_of("<math>" + "<mrow>" * 20_000 + "<mi>deep") == "deep"
