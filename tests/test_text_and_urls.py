import html as html_module

import pytest
from pyspark.sql import functions as F

from answerloom.functions import markup, text, urls


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_strip_and_words_follow_python(spark):
    samples = ["", "  ", " a ", " x y　 z\n", "\x1fq\x1c", "a\tb\r\nc", "one", "​kept​"]
    got = values(spark, [(s,) for s in samples], "t string", text.strip(F.col("t")), text.words(F.col("t")))
    assert got == [(s.strip(), s.split()) for s in samples]


def test_squeeze_newlines(spark):
    rows = [("a\n\n\nb\n\nc\n\n\n\n\nd",)]
    assert values(spark, rows, "t string", text.squeeze_newlines(F.col("t"))) == [("a\n\nb\n\nc\n\nd",)]


def test_utf8_is_strict(spark):
    rows = [(b"ok \xc3\xa9",), (b"bad \xff",), (b"\xc0\x80",), (None,)]
    got = values(spark, rows, "b binary", text.utf8_text(F.col("b")))
    assert got == [("ok é",), (None,), (None,), (None,)]


def test_template_does_not_expand_slot_values(spark):
    template = "Q: {question} C: {context} {{x}}"
    rows = [("what is {context}?", "see {question} $1 \\1")]
    got = values(spark, rows, "q string, c string",
                 text.fill_template(template, question=F.col("q"), context=F.col("c")))
    assert got == [("Q: what is {context}? C: see {question} $1 \\1 {x}",)]
    with pytest.raises(ValueError):
        text.fill_template("{other}", question=F.col("q"))


def test_first_sentence(spark):
    rows = [("One. Two.",), ("v1.2 is out. Next",), ("no stop",), ("",), ("a.\nb.",)]
    got = values(spark, rows, "t string", text.first_sentence(F.col("t")))
    assert [g[0] for g in got] == ["One.", "v1.2 is out.", "no stop", "", "a."]


@pytest.mark.parametrize("href, want", [
    ("https://other.org/x", "https://other.org/x"),
    ("mailto:a@b.c", "mailto:a@b.c"),
    ("//cdn.example/x", "https://cdn.example/x"),
    ("/root?q=1#f", "https://site.example/root?q=1#f"),
    ("#top", "https://site.example/a/b?x=1#top"),
    ("?y=2", "https://site.example/a/b?y=2"),
    ("c", "https://site.example/a/c"),
    ("./c", "https://site.example/a/c"),
    ("../c/./d", "https://site.example/c/d"),
    ("../../../c", "https://site.example/c"),
    ("..", "https://site.example/"),
])
def test_resolve_url(spark, href, want):
    got = values(spark, [("https://site.example/a/b?x=1#here", href)], "b string, h string",
                 urls.resolve_url(F.col("b"), F.col("h")))
    assert got == [(want,)]


def test_file_names_and_hosts(spark):
    rows = [("https://s.example/a/b",), ("https://s.example/a_b",), ("https://s.example/a/b?x=1",),
            ("https://s.example",), ("https://s.example/",), ("https://u:p@S.example:8080/x/",)]
    got = values(spark, rows, "u string", urls.page_file_name(F.col("u")), urls.url_host(F.col("u")))
    assert [g[0] for g in got] == ["a_b.html", "a_b.html", "a_b.html", ".html", ".html", "x.html"]
    assert {g[1] for g in got} == {"s.example"}


def test_same_site_needs_equal_hosts(spark):
    from answerloom.operators.crawl import link_edges

    page = ('<a href="https://site.example.evil/x">a</a><a class="k" href=\'/in\'>b</a><A HREF="up/../y">c</A>'
            '<a name="none">d</a><a href="">e</a>')
    edges = {r.dst: r.same_site for r in link_edges(
        spark.createDataFrame([("https://site.example/p", page)], "url string, html string")).collect()}
    assert edges == {"https://site.example.evil/x": False, "https://site.example/in": True,
                     "https://site.example/y": True}


def test_markdown(spark):
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body>
      <script>var t="</p><h1>no</h1>";</script><!-- <p>no</p> -->
      <h2 class="x">Head &amp; tail</h2><p>One <b>bold</b> and <em>lean</em><br>two &lt;three&gt; &amp;lt;</p>
      <ul><li>first</li><li><a class="l" href="/x">link</a></li></ul><div>A</div><div>B</div>
      <p>&#233;&#x20AC;&#0; <img alt="pic" src="p.png"> <code>x=1</code></p><hr></body></html>"""
    got = values(spark, [(page,)], "h string", markup.html_to_markdown(F.col("h")))[0][0]
    assert got == (
        "## Head & tail\n\nOne **bold** and *lean*\ntwo <three> &lt;\n\n* first\n* [link](/x)\n\nA\n\nB\n\n"
        "é€&#0; ![pic](p.png) `x=1`\n\n---"
    )


GOLDENS = {
    "<ol><li>one<li>two<ul><li>in</li><li>ner<ol><li>x</li></ol></li></ul>tail</li><li>three</li></ol>after":
        "1. one\n2. two\n    * in\n    * ner\n        1. x\ntail\n3. three\n\nafter",
    "<p>a</p><pre>  def f():\n    return 1\n\n\n\t# &lt;b&gt; <b>x</b><br></pre><p>b  c</p>":
        "a\n\n```\n  def f():\n    return 1\n\n\n    # <b> x\n\n```\n\nb c",
    "<table><thead><tr><th>A</th><th>B <b>x</b></th></tr></thead><tbody><tr><td>1</td><td><p>2</p></td></tr><tr><td>3<td>4</table>end":
        "| A | B **x** |\n| --- | --- |\n| 1 | 2 |\n| 3 | 4 |\n\nend",
    "x <a href=\"/x\"><h3>Card</h3></a> y <a class=c href='/q'>q</a> <a href=/z>z</a> <a name=k>n</a> <a data-href=/w>w</a>":
        "x [### Card](/x) y [q](/q) [z](/z) n w",
    "<img src='/i.png' alt='a pic'> <img alt=t src=/j.png> <img SRC=\"k\"> <img data-src=x>":
        "![a pic](/i.png) ![t](/j.png) ![](k)",
    "a <b>bold</b> <i>it</i> <code>c  d</code> <b>open<p>next</p> 5 < 6 &amp; 7 &gt; &#65; </ul></li></a></pre></td>":
        "a **bold** *it* `c d` open\n\nnext\n\n5 < 6 & 7 > A",
    "<h2>T</h2>text<br>more<hr>x\x01y\x12": "## T\n\ntext\nmore\n\n---\n\nxy",
    "<div>" * 3000 + "deep" + "</div>" * 3000: "deep",
    "<p>" + "word " * 20_000 + "</p>": ("word " * 20_000).strip(),
    "": "",
}


def test_markdown_of_lists_tables_links_and_preformatted_text(spark):
    rows = values(spark, [(h,) for h in GOLDENS], "h string", F.col("h"), markup.html_to_markdown(F.col("h")))
    assert {h: m for h, m in rows} == GOLDENS
    assert values(spark, [(None,)], "h string", markup.html_to_markdown(F.col("h")))[0][0] is None


def test_entities_agree_with_the_standard_table(spark):
    for name, character in markup.NAMED.items():
        assert html_module.unescape(f"&{name};").replace("\xa0", " ") == character
    texts = ["&eacute;&times;", "&#00000039;&#x0041;&amp;lt;", "a & b &unknown; &;", "&#0;&#xD800;&#1114112;", "", "&amp", "&amp;amp;"]
    got = values(spark, [(t,) for t in texts], "t string", markup.decode_entities(F.col("t")))
    assert [r[0] for r in got] == ["é×", "'A&lt;", "a & b &unknown; &;", "&#0;&#xD800;&#1114112;", "", "&amp", "&amp;"]


def test_links_in_all_quotings(spark):
    html = """<a data-href="/w" href="/v">1</a><a href=/x>2</a><A class='k' HREF = '/y?a=1&amp;b=2'>3</A>
      <!-- <a href="/no">4</a> --><script>'<a href="/nor">'</script><a name="n">5</a><abbr href="/z">6</abbr><a href="">7</a>"""
    assert values(spark, [(html,)], "h string", urls.page_links(F.col("h")))[0][0] == ["/v", "/x", "/y?a=1&b=2", ""]


def test_crawl_looks_pages_up_without_their_fragment(spark):
    from answerloom.operators.crawl import crawl

    rows = [("https://a.example/p", '<a href="#top">x</a><a href="/q#part">y</a><a href="/gone">z</a>'), ("https://a.example/q", "")]
    pages = spark.createDataFrame(rows, "url string, html string")
    got = {r.url: r.status for r in crawl(pages, pages.select("url").limit(1)).collect()}
    assert got == {"https://a.example/p": "SUCCESS", "https://a.example/q": "SUCCESS",
                   "https://a.example/gone": "ERROR: page not found"}
