"""Visible text of pages."""

import random
import time

import pytest

from skyledger.llm.html_text import DEPTH, extract_text, op10_html_text, render

PAGES = [
    ("", ""), ("plain", "plain"), ("  a \n b\t c  ", "a b c"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br><br>c", "a\nb\n\nc"), ("<div>a</div><div>b</div>", "a\nb"),
    ("<b>a</b> <i>b</i>c", "a bc"), ("a<!-- x -->b<!-->c<!--->d<!-- open", "abcd"), ("1 < 2 & 3 &lt;b&gt; &amp;amp; &copy;&nbsp;x", "1 < 2 & 3 <b> &amp; ©\xa0x"),
    ("<head><title>t</title><style>p{}</style></head><body>x<script>if (a<b) '</p>'</script>y", "xy"), ("<title>t</title>x", "x"), ("<noscript>no</noscript><template>t</template>x", "x"),
    ("<p hidden>h</p><p style='display : none'>n</p><p style=\"visibility:hidden\">v</p><p style='display:block'>s</p>", "s"),
    ("<style>.gone, #off {display:none} b{color:red}</style><i class='a gone'>x</i><i id=off>y</i><b class=a>z</b>", "z"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"), ("<ol start=9><li>a<li value=20>b<li>c</ol>", "9. a\n20. b\n21. c"), ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    ("<ul><li><p>a<p>b</ul>", "- a\n\n  b"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n    d\nu"), ("<blockquote>q<br>r</blockquote>s", "    q\n    r\n\ns"),
    ("<pre>\n a\n\n  b </pre>c", " a\n\n  b\n\nc"), ("<textarea>\n a  b</textarea>", " a  b"), ("a<hr>b", "a\n\n---\n\nb"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"), ("<table><tr><th>漢字<td>x<tr><td>a<td>y</table>", "漢字  x\na     y"),
    ("<table><tr><td colspan=2>wide cell<td>x<tr><td>a<td>b<td>y</table>", "wide cell  x\na  b       y"), ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td>a<br>b<td>c<tr><td><ul><li>x<li>y</ul><td>d</table>", "a    c\nb\n- x  d\n- y"), ("<table><tr><td>a<table><tr><td>i<td>j</table><td>b</table>", "a     b\ni  j"),
    ("<table><caption>cap</caption><tbody><tr><td>a</table>", "cap\na"), ("<td>loose", "loose"), ("</p>x</div></b>y", "xy"), ("<p>a</b>b</i></p>c", "ab\n\nc"),
    ("<select><option>a<option selected>b</select>", "b"), ("<select multiple><option>a<option>b</select>", "a\nb"), ("<input value='v'><input type=hidden value=h><input type=submit value=go>", "vgo"),
    ("<details><summary>s</summary>body</details>", "s"), ("<details open><summary>s</summary>body</details>", "s\nbody"), ("<dialog>x</dialog><dialog open>y</dialog>", "y"),
    ("<a title='x>y' href=z>t</a>", "t"), ("<a title=it's>t</a>", "t"), ("x<a href='", "x"), ("x<", "x<"), ("x</", "x"), ("a<?php x ?>b<!DOCTYPE html>c<![CDATA[d]]>e", "abce"),
    ("<html lang=de><body><h1>H</h1>t</body></html>tail", "H\n\nttail"), ("<SCRIPT>x</scRIPT >y", "y"), ("<svg><title>no</title><g><text>s</text></g><defs><text>d</text></defs></svg><canvas>c</canvas>x", "sx"),
    ("<math><mi>a</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math>", "a=1"),
    ("<style>@media print{nav,.c{display:none}}</style><nav>menu</nav><p class=c>hi</p>", "menu\n\nhi"), ("<style>@media (max-width:600px){.s{display:none}} @media screen and (min-width:9px){i{display:none}}</style><b class=s>x</b><i>y</i>", "x"),
    ("<style>.t{display:none} .t{display:block}</style><i class=t>x</i>", "x"), ("<style>div.x{display:none}</style><div class=x>a</div><p class=x>b</p><div>c</div>", "b\n\nc"),
    ("<style>#a{display:inline} .b{display:none} i{display:none!important}</style><b id=a class=b>x</b><u class=b>y</u><i id=a>z</i>", "x"), ("<style>b{display:none}</style><b style='display:inline'>x</b><b>y</b>", "x"),
    ("<style>p .x{display:none} @supports (x:y){@layer a{.y{visibility:hidden}}} @font-face{display:none}</style><p><i class=x>x</i><i class=y>y</i>", "x"),
    ("<style>/* b{display:none} */ i{color:red;display:none;</style><b>x</b><i>y</i>", "x"), ("<style>.a.b{display:none}</style><i class=a>x</i><i class='b a'>y</i>", "x"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_render(page, text):
    assert render(page) == text


def test_never_fails_and_stays_linear():
    rng = random.Random(10)
    pieces = ["<", ">", "</", "<!--", "-->", "<p>", "</p>", "<table>", "</table>", "<tr>", "<td rowspan=3>", "<li>", "<ul>", "</ul>", "<ol>", "<pre>", "</pre>", "<select>", "<option>", "'", "\"", "=", "&#0;", "&amp", "&#x110000;", "a b", "\n", "<br/>", "<style>p{display:none}", "</style>", "<title>"]
    for _ in range(2000):
        render("".join(rng.choice(pieces) for _ in range(rng.randrange(60))))
    for page in ("<div>" * 60000 + "x", "<" * 200000, "<a b='" * 20000, "<a b=\"" * 20001, "<!--" * 50000, "<table><tr>" + "<td>x" * 20000, "<ul><li>" * 20000, "<td rowspan=60000>" * 3000, "<p>x" * 50000, "<style>" + "@media x{" * 50000 + "</style>", "<style>" + "p{display:none}" * 50000 + "</style>x", "&" * 200000, "</p>" * 50000, "<b>" * 1000 + "</i>" * 50000):
        began = time.process_time()
        render(page)
        assert time.process_time() - began < 6, page[:20]
    assert render("<div>" * (2 * DEPTH) + "deep") == "deep"


def test_column(spark):
    rows = [(i, p, "kept") for i, (p, _) in enumerate(PAGES)] + [(None, None, "kept"), (0, "", "kept")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    got = extract_text(pages).collect()
    want = [(i, t) for i, (_, t) in enumerate(PAGES)] + [(None, None), (0, "")]
    assert sorted(((r["page_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert extract_text(pages.limit(0)).collect() == [] and extract_text(pages, into="visible").columns == ["page_id", "html", "text", "visible"]


def test_query(spark):
    rows = op10_html_text(spark, "/root/testdata/sf0.001").collect()
    assert rows and all("<p>" not in r["text"] and "track(" not in r["text"] and r["n_chars"] == len(r["text"]) and r["n_lines"] == r["text"].count("\n") + 1 for r in rows)
