from pyspark.sql import functions as F

from lexgraph.functions.html import FIELDS, Selectors, scan_page
from lexgraph.operators.html import extract_html, page_keywords, page_terms

PAGE = """<html><head><meta name=" Keywords " content=" k1 k2 "><meta name="image" content="x"></head><body>
<input id="query" value="term"><a href="/item/A">Alpha <b>one</b></a><a href="/item/B?fr=navbar">nav</a>
<a href="/item/C?force=1">skip</a><a href="/other">no</a><a href="/item/D#viewPageContent">D#viewPageContent</a>
<div class="lemmaWgt-lemmaCatalog x"><a href="#1">Intro</a><a href="#1_2">Sub</a><a href="/item/E">E</a></div>
<span class="taglist big">food</span><span class="taglist"> raw  food </span></body></html>"""
FRAGMENT = "<p>An <a href='http://example.com/'><b>example</b></a> link.</p>"


def scan(page, *fields):
    found = scan_page(page, frozenset(fields or FIELDS), Selectors())
    return found[fields[0]] if len(fields) == 1 else found


def texts(page):
    return [link["text"] for link in scan(page, "links")]


def test_page(spark):
    df = spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "id int, bk_html string")
    got = {r.id: r for r in extract_html(df).collect()}
    assert got[1].links == ["Alpha one", "D", "E"]
    assert got[1].tags == ["food", "raw food"]
    assert got[1].input == "term"
    assert got[1].toc == ["Intro"]
    assert got[1].meta == ["k1 k2"]
    for i in (2, 3):
        assert [got[i][f] for f in FIELDS] == [[], [], "", [], [], "", "", "", "", ""]


def test_page_tables(spark):
    df = spark.createDataFrame([("w1", PAGE), ("w2", None), ("w3", "")], "key string, body string")
    assert {tuple(r) for r in page_terms(df).collect()} == {
        ("w1", "Alpha one,D,E", "food,raw food"), ("w2", "none", "none"), ("w3", "", ""),
    }
    assert tuple(page_keywords(df, "key", "body").where("bk_word = 'w1'").first()) == ("w1", "term", "k1 k2", "Intro")


def test_fragments():
    found = scan(FRAGMENT)
    assert found["body_text"] == "An example link."
    assert (found["first_href"], found["first_text"]) == ("http://example.com/", "example")
    assert found["first_inner"] == "<b>example</b>"
    assert found["first_outer"] == '<a href="http://example.com/"><b>example</b></a>'
    meta = '\n<meta name="keywords" content="中国 古代中国">\n<meta name="image" content="http://x/y.png">\n'
    assert scan(meta, "meta") == ["中国 古代中国"]


def test_text_rules():
    assert scan("<p>One</p><p>Two <b>b</b>old</p>x<br>y", "body_text") == "One Two boldx y"
    assert scan("a &amp; b&nbsp;&nbsp;c &copy &#65; &lt;i&gt;", "body_text") == "a & b c © A <i>"
    assert scan("<title>no</title><p>a<script>var x='</p>';</script>b<style>p{}</style><!-- <p>c -->d", "body_text") == "a b d"
    assert scan("x<pre>a\n  b</pre>", "body_text") == "x a\n  b"
    assert scan("1 < 2 <- 3", "body_text") == "1 < 2 <- 3"


def test_broken_markup():
    assert texts('<p>x<a href="/u">foo<p>bar</p>baz <i>q</a>z') == ["foo", "bar", "baz q"]
    assert texts('<a href="/u">one<a href="/v">two') == ["one", "two"]
    assert texts('<ul><li><a href="/u">one<li>two</ul>three') == ["one", "two", "three"]
    assert texts('<a href="/u">one</a><a href="/v') == ["one"]
    assert texts("<A HREF=/u CLASS=x>one</A><a name=n>two</a><a href>three</a>") == ["one", "three"]
    assert scan('<span class="x TagList">a<div>b</span>c</div></span>', "tags") == ["a bc"]
    assert scan("<span class=taglists>a</span><div class=taglist>b</div>", "tags") == []
    assert scan('<input id=other value=1><input value="a &amp; b" id="query"><input id=query value=2>', "input") == "a & b"
    assert scan("<a href='/x?a=1&copy=2&amp;b'>t</a>", "links")[0]["href"] == "/x?a=1&copy=2&b"


def test_long_broken_pages():
    """No page takes more than linear time."""
    assert scan("<p>" + "<b" * 50000, "body_text") == ""
    assert scan("<p>" + "</b" * 50000, "body_text") == ""
    assert scan("<b>" * 50000 + "<p>x" * 50000, "body_text").count("x") == 50000
    assert scan('<a href="' * 50000 + "x", "body_text") == ""
    assert scan("<!--" * 50000 + "x", "body_text") == ""
    assert scan("x" + "<" * 50000, "body_text") == "x" + "<" * 50000


def test_contents_only_inside_the_box():
    page = '<a href="#0">out</a><div class="LEMMAWGT-lemmacatalog"><div><a href="#1">in</a></div></div><a href="#2">out</a>'
    assert [link["text"] for link in scan(page, "toc")] == ["in"]


def test_one_parse_per_page(spark):
    df = spark.createDataFrame([(PAGE,)], "bk_html string")
    plan = extract_html(df).select(F.concat_ws(",", "links", "tags", "toc"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
