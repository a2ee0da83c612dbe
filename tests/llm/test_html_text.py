import html as stdlib
import random
import re
from html.parser import HTMLParser

import pytest

from barsmith.llm.html_text import VOID, extract, render

#: What browsers do not show, as a list of its own.
UNSEEN = set("head title script style template noscript iframe object video audio canvas datalist noembed noframes".split())

CASES = [
    ("", ""), (None, ""), ("plain  text\n here", "plain text here"),
    ("<p>One<p>Two<div>Three</div>four", "One\n\nTwo\n\nThree\nfour"),
    ("<h1>A</h1><p>b <b>bold<i>er</b></i> c</p>", "A\n\nb bolder c"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>after", "- one\n- two\n  - deep\n- three\n\nafter"),
    ("<ol start=9><li>x</li><li>y</li></ol>", "9. x\n10. y"),
    ("<table><tr><td>a<td>long cell<tr><td>bbb<td>c</table>", "a    long cell\nbbb  c"),
    ("x<table><tbody><tr><th>H</th><th>I</th></tr><tr><td colspan=2>wide</td></tr></table>y", "x\n\nH  I\nwide\n\ny"),
    ("<table><tr><td>a<br>b</td><td>c</td></tr></table>", "a  c\nb"),
    ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
    ("<td>loose</td>", "loose"),
    ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"),
    ("<script>var a='<p>no</p>';</script><style>p{}</style>yes<noscript>no</noscript>", "yes"),
    ("<head><title>no</title></head><body>yes<template>no</template>", "yes"),
    ("<p hidden>no</p><p style='color:red; display: none'>no</p><div style=\"visibility:hidden\">no</div>yes", "yes"),
    ("<div hidden><p>no</div>yes", "yes"), ("&lt;b&gt; &amp; &eacute;&#233;", "<b> & éé"),
    ("a<!-- no --><!doctype html><?php no ?>b", "ab"), ("a<!-- open", "a"), ("a<b", "a"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("</p>x</div></li>", "x"), ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"), ("<textarea><b>x</b></textarea>", "<b>x</b>"),
    ('<a title="x > y">z</a>', "z"), ("<P>Up</P><UL><LI>Case</UL>", "Up\n\n- Case"), ("<select><option>a<option>b</select>c", "ac"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_rendering(page, text):
    assert render(page)[0] == text


class Plain(HTMLParser):
    """Visible words by the standard library's parser, for well-formed pages."""

    def __init__(self):
        super().__init__()
        self.words, self.unseen = [], 0

    def handle_starttag(self, tag, attrs):
        self.unseen += tag in UNSEEN and tag not in VOID

    def handle_endtag(self, tag):
        self.unseen -= tag in UNSEEN and tag not in VOID
        if not self.unseen:
            self.words.append(" ")

    def handle_data(self, data):
        if not self.unseen:
            self.words.append(data)


def test_all_visible_words_in_order():
    rng = random.Random(5)

    def node(depth):
        if depth == 0 or rng.random() < .3:
            return " ".join(rng.choice(["a", "bé", "c&amp;d", "&lt;x&gt;", "word"]) for _ in range(rng.randint(0, 4))) + " "
        tag = rng.choice("div p ul table span pre script h2 section".split())
        inner = "".join(node(depth - 1) for _ in range(rng.randint(0, 3)))
        if tag == "p":
            inner = re.sub("<[^>]*>", " ", inner)
        if tag == "ul":
            return f"<ul><li>{inner}</li><li>{node(depth - 1)}</li></ul>"
        if tag == "table":
            return f"<table><tr><td>{node(0)}</td><td>{node(0)}</td></tr></table>"
        return f"<{tag}>{'x = 1' if tag == 'script' else inner}</{tag}>"
    for _ in range(300):
        page = "".join(node(4) for _ in range(3))
        plain = Plain()
        plain.feed(page)
        plain.close()
        got = re.sub(r"(?m)^[ ]*(- ?)+", "", render(page)[0])
        assert sorted(got.split()) == sorted("".join(plain.words).split()), page


@pytest.mark.parametrize("page, text", [
    ('<div style="visibility:hidden">no<p style="visibility:visible">yes<b style="visibility:collapse">no</b></div>a', "yes\n\na"),
    ('<ul style="visibility:hidden"><li>no<li style="visibility:visible">x</ul>', "- x"), ("<svg visibility=hidden><text>no</text><text visibility=visible>A</text></svg>", "A"),
    ('<div style="display:none">no<p style="display:block;visibility:visible">no</div>x', "x"),
    ("<dialog>no</dialog>x<dialog open>yes</dialog>", "x\nyes"), ("<details><summary>s</summary>in</details>", "s\nin"),
    ("a <select><option>x<option selected>y<option>z</select> b", "a y b"), ("<select><option disabled>x<option>y</select>", "y"),
    ("<select><option selected>x<option selected>y</select>", "y"), ("<select>no<option label=L>x</select>", "L"), ("<select></select>x", "x"),
    ("<select><optgroup label=G disabled><option>x</optgroup><option>y</select>", "y"), ("<select hidden><option>no</select>x", "x"),
    ("<select multiple><optgroup label=G><option>x<option>y</select>z", "G\nx\ny\nz"), ("<select size=2><option>x<option>y</select>", "x\ny"),
    ("<table><tr><td><select><option>a<option>b<td>c</table>", "a  c"), ("<option>x<option>y", "x\ny"),
    ("<form>a <input type=submit value='Go &amp; see'> <input type=hidden value=no><input type=password value=no><input value=in></form>", "a Go & see in"),
    ("<input type=checkbox value=no><input type=Button value=ok style='display:none'><button>B</button>", "B"),
    ("<ol><li value=7>x<li>y<li value=z>w</ol>", "7. x\n8. y\n9. w"), ("<ol reversed><li>a<li>b<ol reversed><li>c<li>d<li>e</ol></ol>", "2. a\n1. b\n   3. c\n   2. d\n   1. e"),
    ("<ol reversed start=5><li>a<li>b</ol>", "5. a\n4. b"), ("<ol><li>a<ul><li>b</ul><li>c</ol>", "1. a\n   - b\n2. c"),
])
def test_controls_numbers_and_visibility(page, text):
    assert render(page)[0] == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td rowspan=2>A<td>b1<tr><td>b2</table>", "A  b1\n   b2"), ("<table><tr><td rowspan=2>A<br>B<br>C<td>b1<tr><td>b2</table>", "A  b1\nB  b2\nC"),
    ("<table><tr><td>a<td rowspan=2>X<td>c<tr><td>d<td>e</table>", "a  X  c\nd     e"), ("<table><tr><td rowspan=0>A<td>1<tr><td>2<tr><td>3</table>", "A  1\n   2\n   3"),
    ("<table><tr><td rowspan=2 colspan=2>A<td>1<tr><td>2<tr><td>x<td>y<td>3</table>", "A     1\n      2\nx  y  3"),
    ("<table><tbody><tr><td rowspan=9>A<td>1<tbody><tr><td>x<td>2</table>", "A  1\nx  2"), ("<table><tr><td rowspan=5>A<br>B</table>", "A\nB"),
    ("<table><tr><td rowspan=2>A<td rowspan=2>B<tr><tr><td>c</table>", "A  B\nc"), ("<table><tr><td rowspan=99999999 colspan=99999999>A<tr><td>b</table>", "A  b"),
    ("<table><tr><td>a<td><td>b<tr><td>c<td>d<td>e</table>", "a     b\nc  d  e"), ("<table></table>x", "x"), ("<table><tbody></table>x", "x"),
    ("<table><tr><td rowspan=2>A<td>1<tr><td>2</table>" * 2, "A  1\n   2\n\nA  1\n   2"),
])
def test_cells_over_rows_and_columns(page, text):
    assert render(page)[0] == text


def test_cells_of_random_spans_keep_their_columns():
    """Against a grid filled cell by cell."""
    rng = random.Random(8)
    for _ in range(300):
        height, wide, grid, page, n = rng.randint(1, 5), rng.randint(1, 5), {}, "<table>", 0
        for r in range(height):
            page += "<tr>"
            for c in range(wide):
                if (r, c) in grid:
                    continue
                columns, rows, n = 1, rng.randint(1, height - r), n + 1
                while c + columns < wide and (r, c + columns) not in grid and rng.random() < .3:
                    columns += 1
                grid.update({(r + i, c + j): f"w{n:02}" if not i and not j else "" for i in range(rows) for j in range(columns)})
                page += f"<td colspan={columns} rowspan={rows}>w{n:02}"
        lines, first = render(page + "</table>")[0].split("\n"), {w: c for (r, c), w in grid.items() if w}
        words = [(w, m.start()) for line in lines for m in re.finditer(r"w\d\d", line) for w in [m[0]]]
        assert sorted(w for w, _ in words) == sorted(first), page
        at = {}
        for w, x in words:
            at.setdefault(first[w], set()).add(x)
        edges = [min(at[c]) for c in sorted(at)]  # equal where no cell ends between two columns
        assert all(len(x) == 1 for x in at.values()) and edges == sorted(edges), (page, lines)


def test_depth_and_length():
    assert render("<div>" * 50_000 + "x" + "</div>" * 50_000)[0] == "x"
    assert render("<b>" * 20_000 + "y")[0] == "y"
    assert len(render("<p>word</p>" * 50_000)[0].split()) == 50_000
    assert stdlib.unescape("&amp;") == "&"


def test_the_query_renders_every_page(spark):
    from barsmith.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    expected = sorted((r.page_id, *render(r.html)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect())
    got = sorted((r.page_id, r.text, r.n_tables) for r in QUERIES["op10_html_text"](spark, sf).collect())
    assert got == expected and len(got) > 100


def test_pages(spark):
    pages = spark.createDataFrame([(1, "<p>a", 1), (1, "<p>a", 1), (None, "<td>b", 2), (3, None, 3), (4, "", 4)], "page_id long, html string, text long")
    got = sorted((r.page_id or 0, r.text, r.n_lines) for r in extract(pages).collect())
    assert got == [(0, "b", 1), (1, "a", 1), (1, "a", 1), (3, "", 0), (4, "", 0)]
    assert extract(pages.filter("page_id > 9")).count() == 0


@pytest.mark.parametrize("page, text", [
    ('<a title="the hidden gem">x</a>', "x"), ('<body class="md:block hidden lg:flex">x', "x"), ("<p data-tip='use display:none'>x", "x"),
    ('<p title="visibility: hidden">x', "x"), ("<p class=a data-x=hidden aria-hidden=true>x", "x"), ('<p style="--note: a;display:block">x', "x"),
    ("<p style=\"background:url('display:none;display:none')\">x", "x"), ('<p style="display:none;display:block">x', "x"),
    ('<p style="/* display:none */">x', "x"), ("<p style='display:none!important;display:block'>no</p>x", "x"),
    ("<p HIDDEN=''>no</p><p/hidden>no</p><p class='a'hidden>no</p><p STYLE=display:none>no</p>x", "x"),
    ('<p style="display&#58;none">no</p><p style="color:red;\nDISPLAY : none">no</p>x', "x"), ("<p title='>' hidden>no</p>x", "x"),
    ('<table><tr><td title="a colspan=2">a<td>b<tr><td>long<td>c</table>', "a     b\nlong  c"), ('<ol title=" start=7"><li>x</ol>', "1. x"),
])
def test_only_the_attributes_that_hide_hide(page, text):
    assert render(page)[0] == text


@pytest.mark.parametrize("page, text", [
    ("<p>a <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> b", "a x= 1 2 b"),
    ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text x=1>One</text><text><tspan>Two</tspan></text></svg>", "One\nTwo"),
    ("<svg><path d='M0'/><g/><title/><text>A</text></svg>b", "A\nb"), ("<svg><defs/><text>A</text></svg>", "A"), ("<svg/>a", "a"),
    ("<svg><style>no</style><script>no</script><symbol><text>no</text></symbol></svg>a", "a"),
    ("<math><semantics><mi>y</mi><annotation encoding='application/x-tex'>no</annotation></semantics></math>", "y"),
    ("<svg><foreignObject><div>in<style>no</style></div></foreignObject></svg>", "in"), ("<svg><defs><p>out", "out"),
    ("<svg><g display=none><text>no</text></g><text visibility='hidden'>no</text><text>A</text></svg>", "A"),
    ("<svg style='display:none'><text>no</text></svg>a", "a"), ("<table><tr><td><svg><text>A</text></svg><td>B</table>", "A  B"),
    ("<svg>" + "<g>" * 50_000 + "<text>A", "A"), ("<math><mtext>if <b>so</b></mtext></math>", "if so"),
])
def test_drawings_and_formulas_are_seen(page, text):
    assert render(page)[0] == text


def test_words_of_drawings_against_an_own_list():
    unseen = {"script", "style", "template", "title", "desc", "defs", "metadata", "annotation"}

    class Seen(Plain):
        def handle_starttag(self, tag, attrs):
            self.unseen += tag in unseen

        def handle_endtag(self, tag):
            self.unseen -= tag in unseen
            if not self.unseen:
                self.words.append(" ")
    rng = random.Random(6)
    parts = ["<p>{0}</p>", "<svg><title>{0}</title><text>{1}</text></svg>", "<svg><defs><text>{0}</text></defs><text>{1}</text></svg>",
             "<p><math><mi>{0}</mi> <annotation>{1}</annotation></math></p>", "<script>{0}</script>", "<template>{0}</template>"]
    for _ in range(200):
        page = "".join(rng.choice(parts).format(rng.randrange(99), rng.randrange(99)) for _ in range(5))
        plain = Seen()
        plain.feed(page)
        plain.close()
        assert sorted(render(page)[0].split()) == sorted("".join(plain.words).split()), page
