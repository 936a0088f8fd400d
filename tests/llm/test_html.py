import re
from collections import Counter
from html.parser import HTMLParser

from plain import FOLDER, rows

from carepath.llm import QUERIES
from carepath.llm.html import visible_text

PAGE = """<html><head><title>T</title></head><body><h1>Head &amp; x</h1><p>one<p>two <b>bold</b><br>line
<ul><li>a<li>b<ol start=3><li>c</li><li><p>d</p></li></ol><li>e</ul><div>x<span hidden>no</span>y</div>z<div style="display: none">q</div>
<table><caption>cap</caption><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td rowspan=2>be<td>22<tr><td>333<tr><td colspan=2>wide wide wide cell
<tr><td>x<br>y<td>z</table><pre>  a
    b

c</pre><dl><dt>t<dd>def</dl><details><summary>S</summary>hid</details><script>var a="</p>";</script>a < b <i>c</i>
tail <a href='x>y'>link</a><blockquote>q<p>r</blockquote>end &am"""
TEXT = """Head & x

one

two bold
line

- a
- b
  3. c
  4. d
- e

xy
z

cap
Name   N
alpha  1
be     22
       333
wide wide wide cell
x      z
y

  a
    b

c

t
  def

S
a < b c tail link

  q

  r

end &am"""


def test_layout():
    assert visible_text(PAGE) == TEXT


def test_cases():
    assert visible_text(None) is None and visible_text("") == ""
    assert visible_text("plain") == "plain" and visible_text("<b>cut off") == "cut off"
    assert visible_text("a</p></div>b<!-- c -- > d -->e<![CDATA[<f>]]>") == "abe<f>"
    assert visible_text("<p>a<script>x</script >b<style>c") == "ab"
    assert visible_text("<a title=\"x") == ""
    assert visible_text("1 < 2 <3 >") == "1 < 2 <3 >"
    assert visible_text("<td>lone cell") == "lone cell"
    assert visible_text("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>") == "a     d\nb  c"
    assert visible_text("<ol><li value=7>a<li>b</ol>") == "7. a\n8. b"
    assert visible_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "end").split() == ["deep", "end"]
    assert visible_text("<table><tr>" * 60 + "<td>deep").split() == ["deep"]
    assert visible_text("<p hidden>a<p style='visibility:hidden'>b<input type=hidden value=x>c</p>d") == "d"
    assert visible_text("<" * 20_000 + "x" * 20_000) == "<" * 19_999
    assert visible_text("<select><option>a<option>b</select>") == "a\nb"


class Data(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.head = [], 0

    def handle_starttag(self, tag, attrs):
        self.head += tag == "head"

    def handle_endtag(self, tag):
        self.head -= tag == "head"

    def handle_data(self, data):
        if not self.head:
            self.found.append(data)


def test_all_text_of_the_pages(spark):
    pages = rows("pages", "page_id, html")
    got = {r.page_id: r.text for r in QUERIES["op4_html_text"](spark, FOLDER).collect()}
    assert len(got) == len(pages)
    for i, page in pages:
        parser = Data()
        parser.feed(page)
        parser.close()
        want = Counter(re.sub(r"\s", "", "".join(parser.found)))
        found = Counter(re.sub(r"\s", "", re.sub(r"(?m)^- ", "", got[i])))
        assert found == want, i


def test_tables_of_pages(spark):
    from carepath.llm.html import extract

    df = spark.createDataFrame([(1, None, "x"), (2, "<p>a", "y"), (2, "<p>a", "y"), (None, "b", None)], "page_id long, html string, text string")
    got = sorted((r.page_id or 0, r.text) for r in extract(df).collect() if r.page_id != 1)
    assert got == [(0, "b"), (2, "a"), (2, "a")]
    assert extract(df.limit(0)).count() == 0


def test_long_attribute_values():
    for n in (10, 8_192, 100_000):
        for q, other in ("\"'", "'\""):
            long = "a>" + f"<b>{other}" * (n // 4) + ">"
            assert visible_text(f"<p>x</p><div data-x={q}{long}{q} hidden>no</div><p title = {q}{long}{q}>y</p>") == "x\n\ny"
            assert visible_text(f"<p>x</p><p/ title={q}{long}{q}/>y</p {q} a={q}>{q}>z") == "x\n\ny\n\nz"
    assert visible_text("<p title=it's>a 'b' > c</p>") == "a 'b' > c"
    assert visible_text("<p title=\"a>b</p><i>c") == "b\n\nc"
    assert len(visible_text("<p a=\">x" * 100_000)) < 10**6


def test_visibility():
    hidden = "<div style='visibility:hidden'>a<b style='visibility: VISIBLE'>b<i>c</i></b>d<p>e</div>f"
    assert visible_text(hidden) == "bc\n\nf"
    assert visible_text("<p style='display:none;display:block'>a<p style='display:block;display:none'>b") == "a"
    assert visible_text("<p style='display:none!important;display:block'>a<p style='color:red'>b") == "b"
    rows = "<tr style='visibility:collapse'><td>a<td style='visibility:visible'>b<tr><td style='visibility:hidden'>c<td>d"
    assert visible_text(f"<table>{rows}</table>") == "  b\n  d"  # a hidden cell keeps its place
    assert visible_text(f"<div style='visibility:hidden'><table>{rows}</table></div>") == "  b"
    assert visible_text("<ruby>x<rp>(</rp><rt>y</rt><rp>)</rp></ruby>") == "xy"


def test_drawings_formulas_and_forms():
    svg = "<svg><title>t</title><defs><text>no</text></defs><path d='m'/>loose<g><text x=1>one <tspan>two</tspan></text><text>three</text></g></svg>"
    assert visible_text(f"<p>a{svg}b</p>") == "a one two three b"
    assert visible_text("<svg><rect/><foreignObject><div>in</div></foreignObject></svg>") == "in"
    assert visible_text("<math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></semantics></math>") == "x=1"
    assert visible_text("<input type=submit value='Go &amp; on'><input value=no><input type=hidden value=no>x") == "Go & on x"
    assert visible_text("<textarea>a <b>b</b> &lt;c&gt;</textarea>d") == "a <b>b</b> <c>\nd"
    assert visible_text("<svg><text>cut off") == "cut off"


def test_large_tables_take_linear_time():
    import time

    began = time.monotonic()
    assert visible_text("<table><tr>" + "<td>x" * 50_000 + "</table>").count("x") == 50_000
    assert visible_text("<table>" + ("<tr>" + "<td colspan=100>x" * 400) * 20 + "</table>").count("x") == 8_000
    assert visible_text("<table><tr>" + "<td rowspan=60000>x" * 5_000 + "<tr><td>y" * 5_000 + "</table>").count("y") == 5_000
    assert time.monotonic() - began < 20


def test_rows_under_spanning_cells():
    page = "<table><tr><td rowspan=3>a<td>b<td rowspan=2>c<tr><td>d<td>e<tr><td>f<td>g<tr><td>h</table>"
    assert visible_text(page) == "a  b  c\n   d     e\n   f  g\nh"


def test_unclosed_quotes_take_linear_time():
    import time

    began = time.monotonic()
    visible_text("<p a='\">x" * 100_000 + "<p " + "= " * 100_000 + "/ " * 100_000)
    assert time.monotonic() - began < 20
