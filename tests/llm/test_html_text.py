import random
import re

import pytest

from logweave.llm.html_text import page_text, table_lines, visible_text

CASES = [
    ("<p>a  b\n c</p><p>d</p>", "a b c\n\nd"),
    ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    ("<h1>T</h1>x<br>y<br><br>z", "T\n\nx\ny\n\nz"),
    ("a<b> bold</b><i>er</i> <span>c</span>d", "a bolder cd"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=9><li>a</li><li>b<p>more</p></li><li value=20>c</li></ol>", "9. a\n10. b\n    more\n20. c"),
    ("<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>x<td>22</table>", "name       n\nlong name  1\nx          22"),
    ("<table><caption>C</caption><tr><td colspan=2>ab<td>c<tr><td rowspan=2>d<td>e<td>f<tr><td>g<td>h</table>z", "C\nab     c\nd   e  f\n    g  h\n\nz"),
    ("<pre>\n a\n  b</pre>", " a\n  b"),
    ("<script>var t='</p>';</script><style>p{}</style>x<!-- c --><noscript>no</noscript>", "x"),
    ("<div hidden>a</div><p style='color:red; display : none'>b</p><p style=visibility:hidden>c</p>d", "d"),
    ("<style>.ad, #x {display:none} nav{visibility:hidden}</style><div class='q ad'>a</div><p id=x>b</p><nav>c</nav>d", "d"),
    ("<details><summary>s</summary>closed</details><details open><summary>t</summary>o</details><dialog>x</dialog>", "s\n\nt\no"),
    ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
    ("x &amp; y &lt;z&gt; &eacute; &#65;", "x & y <z> é A"),
    ("</p></div>stray<p>a</span>b</p></p>c", "stray\n\nab\n\nc"),
    ("<img alt='pic' src=x> <a href=/>l</a><input type=hidden value=v><hr>t", "pic l\n\n----\n\nt"),
    ("<html><head><title> T  t </title></head><body>b", "b"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a in ner  b"),
    ("<blockquote>q<br>r</blockquote>s", "  q\n  r\n\ns"),
    ("", ""), (None, ""), ("plain", "plain"), ("<", "<"), ("<table></table>x", "x"), ("<select><option>a<option>b</select>", "a\nb"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_layout(html, text):
    assert page_text(html)[1] == text


def test_title():
    assert page_text("<title> A\n b </title>x")[0] == "A b" and page_text("x")[0] is None


def test_depth_is_not_limited():
    assert page_text("<div><ul><li>" * 20_000 + "deep")[1].endswith("deep")


def test_wide_columns_are_not_padded():
    rows = [[("x" * 5000, 1, 1), ("a", 1, 1)], [("y", 1, 1), ("b", 1, 1)]]
    assert table_lines(rows) == "x" * 5000 + "  a\ny  b"


def brute_words(html):
    """Words of a page without hidden parts, by cutting tags (the test pages are well nested there)."""
    for tag in ("script", "style", "title", "head", "noscript"):
        html = re.sub(rf"(?s)<{tag}[ >].*?</{tag}>", " ", html)
    html = re.sub(r"(?s)<!--.*?-->", " ", html)
    html = re.sub(r"</?(b|i|em|strong|span|a|u)( [^>]*)?>", "", html)
    import html as h

    return h.unescape(re.sub(r"(?s)<[^>]*>", " ", html)).split()


def test_all_visible_words_of_the_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    rows = visible_text(pages).collect()
    assert len(rows) == len(html)
    odd = 0
    for r in rows:
        want = brute_words(html[r.page_id])
        got = [w for w in r.text.split()]
        if [w for w in got if w not in ("-", "----")] != [w for w in want if w not in ("-", "----")]:
            odd += 1
    assert odd <= len(rows) * 0.02


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "<p>a</p>"), (3, "<p>a</p>"), (None, "<b>x"), (4, "<p>" + "w " * 300_000), (5, "\x00<p>\x00")]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "1 as text", "2 as title")
    got = sorted((r.page_id or -1, len(r.text)) for r in visible_text(df).collect())
    assert [g for g in got if g[0] != 5] == [(-1, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 599_999)]
    assert visible_text(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_random_markup_never_fails():
    rng = random.Random(1)
    tags = "p div ul ol li table tr td th b br pre dl dt dd details summary select option blockquote hr h1 html body head title style script".split()
    for _ in range(400):
        html = "".join(rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", "word ", "&lt;", " ", "<!--", "-->", "<td colspan=3 rowspan=2>"]) for _ in range(60))
        page_text(html)


@pytest.mark.parametrize("html,text", [
    ("<style>@media print { .content {display:none} }</style><p class=content>a</p>b", "a\n\nb"),
    ("<style>@media (max-width: 600px) {nav{display:none} p{color:red}} .ad{display:none}</style><nav>n</nav><p class=ad>x</p>b", "n\nb"),
    ("<style>@supports (x:y) { @media screen { .a{display:none} } }</style><i class=a>a</i>", "a"),
    ("<style>@import 'x;y}'; @media Screen, print {.a{content:'}';display:none}} @media all{.b{display:none}}</style><i class=a>a</i><i class=b>b</i>c", "c"),
    ("<style>.a { color: red; .b {display:none} }</style><i class=a>a</i>", "a"),
    ("<svg><title>t</title><desc>d</desc><style>.q{}</style><text>one</text><text>two</text></svg> x", "one two x"),
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> b <desc>c</desc>", "a x=2 b c"),
])
def test_text_that_a_screen_shows(html, text):
    assert page_text(html)[1] == text
