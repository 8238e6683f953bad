"""Extraction from hand-made pages, and from the given ones against a plain reading of their article element."""

import html as htmllib
import re

from pyspark.sql import functions as F

from sparkcorpus.llm import html_extraction as ex
from sparkcorpus.llm.queries import op6_html_extraction

P = "A paragraph of the text with enough words to count as such, said once. "


def text_of(page):
    return ex.Page(page).text([])


def test_noise_goes():
    page = f"""<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
    <header class="site-header"><h2>Site</h2></header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div>
    <div id="wrapper"><div class="sidebar"><p>Side {P}</p></div><div class="post-12 entry"><h1>The&nbsp;Title &amp; more</h1>
    <p>{P}<a href="y">linked</a> wo<b>r</b>d</p><div class="ad-slot">Buy</div><ul><li>one<li>two</ul><form><input>Mail</form>
    <pre>a
       b</pre><!-- no --><table><tr><td>c1<td>c2</table><p>1 &lt; 2<br>next</div>
    <section id="comments"><p>Reader {P}</p></section></div><aside>{P}</aside><footer>&copy; x</footer></body></html>"""
    assert text_of(page) == f"The Title & more {P}linked word one two a b c1 c2 1 < 2 next"


def test_articles_and_odd_pages():
    assert text_of(f"<body><article><h1>T</h1><p><b>Open.<br><p>{P}</p></article><div>x</div>") == f"T Open. {P.strip()}"
    assert text_of(f"<main><article><header><h1>T</h1></header>{P}</article></main><p>rest") == f"T {P.strip()}"
    assert text_of("") == "" and text_of("<script>x") == "" and text_of("no tags at all") == "no tags at all"
    assert text_of("<p title='a>b'>x</p><p title=\"open>y</p>") == "x y"
    assert text_of("a < b <3 &am &amp c") == "a < b <3 &am & c"
    assert text_of("<nav>" + "<a href=x>m</a>" * 3) == ""
    deep = "<div>" * 3000 + P + "</div>" * 3000
    assert text_of(deep) == P.strip()


def test_forms_and_doubtful_names():
    assert text_of(f"<body><form id=aspnet><nav>n</nav><div><p>{P}</p><p>two</p></div></form></body>") == f"{P}two"
    assert text_of(f"<body><div><p>{P}</p><form><label>Mail</label></form></div></body>") == P.strip()
    body = f"<article><p>{P}</p><div class='related-work'>earlier work</div><div id=social-history>history</div><div class='related-posts'>links</div><div class=share>s</div></article>"
    assert text_of(f"<body>{body}</body>") == f"{P}earlier work history"


def test_empty_winner_does_not_hide_the_article(spark):
    full, empty = (f"<body><div class=lead>{lead}</div><div class=text>{body}</div></body>" for lead, body in ((P * 6, "x"), ("", P * 2)))
    rows = [(i, "https://a.org/", full) for i in range(5)] + [(9, "https://a.org/9", empty)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.row.page_id: r.text for r in ex.extract(pages).collect()}
    assert got == {i: (P * 6).strip() for i in range(5)} | {9: (P * 2).strip()}


def test_consensus_of_host(spark):
    usual = "<body><div class='story9'>%s</div><div class=box>%s</div></body>"
    short = usual % ("short", "boxed " * 40)
    rows = [(i, f"https://a.org/{i}", usual % (f"text {i} " + P * 5, "box"), "k") for i in range(5)]
    rows += [(10, "http://u@A.org:80/x?y", short, "k"), (11, "http://b.org", short, "k"), (12, None, None, "k"), (13, "odd", "", None), (1, "https://a.org/1", short, "k")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = [(r.row.page_id, r.text) for r in ex.extract(pages).collect()]
    boxed = " ".join(["boxed"] * 40)
    want = [(i, f"text {i} {(P * 5).strip()}") for i in range(5)] + [(10, "short"), (11, boxed), (12, ""), (13, ""), (1, "short")]
    assert sorted(got) == sorted((a, " ".join(b.split())) for a, b in want)
    assert ex.extract(pages.limit(0)).count() == 0
    assert {r.host: r.paths for r in ex.consensus(pages).collect()}["a.org"] == ["body/div.story", "body/div.box"]


def plain_article(page):
    inner = re.search(r"<article>(.*?)(</article>|$)", page or "", re.DOTALL)
    pieces = re.split(r"</?(?:p|h1|br|li|ul)>", re.sub(r"</?(?:b|i|a)\b[^>]*>", "", inner[1]) if inner else "")
    return " ".join(filter(None, (" ".join(htmllib.unescape(x).split()) for x in pieces)))


def test_query(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
        got = {r.page_id: (r.url, r.text, r.n_chars) for r in op6_html_extraction(spark, sf).collect()}
        for p in pages:
            want = plain_article(p.html)
            assert got[p.page_id] == (p.url, want, len(want))
