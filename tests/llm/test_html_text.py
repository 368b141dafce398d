"""Main text of pages against texts known beforehand."""

import html
import re

from playmart.llm import html_text

SCHEMA = "page_id long, url string, html string, text string"


def texts(spark, rows):
    df = spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(rows)], SCHEMA)
    return [r["text"] for r in html_text.extract(df).orderBy("page_id").collect()]


def expected(page):
    """For the plain pages of the test tables: heading and paragraphs of the one article."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:h1|p)>", re.sub(r"<br>|</?b>", " ", inner))
    lines = (" ".join(html.unescape(p).split()) for p in parts)
    return "\n".join(x for x in lines if x)


def test_given_pages(spark, small):
    table = spark.read.parquet(f"{small}/pages.parquet")
    want = {r["page_id"]: expected(r["html"]) for r in table.collect()}
    got = {r["page_id"]: r["text"] for r in html_text.extract(table).collect()}
    assert got == want


def test_what_is_not_the_article(spark):
    p = "<p>" + "The article says a number of things, one by one. " * 3
    body = f"""<header class="site"><h1>Site</h1></header><nav>Menu</nav><div id="cookie-notice">We use cookies, a lot of them, on all pages here.</div>
      <div class="main-content"><article class="post post-17"><header><h1>Title &amp; more</h1></header>{p}</p><p>A<br>B &lt;b&gt; &amp;amp; <b>bold</b>&nbsp;x</p>
      <div class="advert-box">Buy this now</div><form><label>Mail</label><input><button>Go</button></form><ul><li>one<li>two</ul>
      <table><tr><td>c1</td><td>c2</td></tr></table><script>if (a<b) document.write("<p>no</p>")</script><style>p>a{{}}</style><!-- <p>hidden</p> -->
      <section class="comments"><p>Reader: I have something long to say about it all, and more.</p></section></article></div>
      <aside><p>Side text that is quite long, as long as a paragraph may be here.</p></aside><footer>End</footer>"""
    first = "The article says a number of things, one by one. " * 3
    want = f"Title & more\n{first.strip()}\nA B <b> &amp; bold x\none\ntwo\nc1\nc2"
    assert texts(spark, [("http://a.b/1", f"<html><body>{body}</body></html>"), ("http://a.b/2", body)]) == [want, want]


def test_votes_of_the_host_decide(spark):
    long, short = "Plain words of the story go on and on here. " * 8, "Short story."
    page = '<body><div class="c{n}"><p>{text}</p></div><div class="x"><p>{other}</p></div></body>'
    rows = [("http://h/", page.format(n=k, text=long, other="Teaser text.")) for k in range(5)] + [("http://h/", page.format(n=9, text=short, other="A long teaser on some page. " * 6))]
    assert texts(spark, rows)[-1] == short
    assert texts(spark, [("http://other/", rows[-1][1])]) != [short]


def test_odd_rows(spark):
    rows = [
        (None, None), ("x", ""), ("http://a", "plain  text"), ("http://a", "<p>unclosed <b>bold"), ("http://a", "<!-- never ends <p>x</p>"), ("http://a", "<p>a</p><p"),
        ("http://a", "<div " + "<div>" * 3000 + "deep"), ("http://a", "<p>" + "w " * 200_000 + "</p>"), ("http://a", "</div></p>x<div title='>'>y</div>"), ("http://a", "<script>x"),
    ]
    got = texts(spark, rows)
    assert got[:5] == ["", "", "plain text", "unclosed bold", ""]
    assert got[6] == "deep" and got[7] == ("w " * 200_000).strip() and got[8] == "x\ny" and got[9] == ""
    assert texts(spark, []) == []


def test_time_is_linear_in_the_page():
    import time

    pages = [
        "<a " * 400_000, "<i>" * 20_000 + "</x>" * 100_000, "<div>" * 50_000 + "text" + "</div>" * 50_000, "<div>words " * 30_000, '<a ">" ' * 20_000, "<" * 300_000,
        "<p " + "a" * 500_000 + ">x", "<i><h1>x</h1>" * 30_000, "<li><ul>" * 20_000, '<p class="' + "b " * 200_000 + '">x', "&amp;<!" * 100_000, "<!-- " * 100_000, "x<![CDATA[" * 50_000,
    ]
    for html in pages:
        began = time.time()
        page = html_text.Page(html)
        page.text(html_text.best(page.scores()))
        assert time.time() - began < 12, html[:30]


def test_marks_in_capitals_open_heads_and_formulas():
    def text(html):
        page = html_text.Page(html)
        return page.text(html_text.best(page.scores()))

    words = "some words of the article that go on for a while, so that it is long enough. "
    assert text(f'<body><div class="SIDEBAR">{words}</div><div class="mainContent"><p>{words}</p></div>') == words.strip()
    assert text(f"<html><head><title>t</title><meta charset=utf8><div><p>{words}</p></div>") == words.strip()
    assert text(f"<html><head><script>var a = '<p>';</script>{words}") == words.strip()
    assert text(f"<p>{words}<math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == f"{words.strip()} x=2 holds"
    assert text("<p>a < b <!-- c --> d <? e ?> f <![CDATA[ g ]]> h <3 i") == "a < b d f h <3 i"


def test_words_that_only_sound_like_marks_lose_nothing():
    def text(html):
        page = html_text.Page(html)
        return page.text(html_text.best(page.scores()))

    words = "some words of the article that go on for a while, so that it is long enough."
    menu = '<nav><a href="/">Home</a></nav><div class="sidebar"><p>Other things that the site has, in a line or two.</p></div>'
    for around in ('<div class="content-banner-layout">', '<div class="with-sidebar">', '<form id="aspnetForm"><div>', '<div class="widget">', '<div id="popup" class="modal">'):
        assert text(f'<body class="has-sidebar">{around}{menu}<p>{words}</p><p>{words}</p>') == f"{words}\n{words}", around
    for inside in ('<p class="share-price">', '<p class="social-history">', '<section id="comment-on-law">', '<div class="related-work">'):
        assert text(f"<article><p>{words}</p>{inside}{words}") == f"{words}\n{words}", inside
    for gone in ('<div class="share-buttons">', '<div class="related-posts">', '<section id="comments">', '<div class="ad-slot top">', '<ul class="promo-links">', '<div class="cookie-consent-box">'):
        assert text(f"<article><p>{words}</p>{gone}<p>{words}") == words, gone
    links = '<div class="our-related-picks"><p><a>one thing</a> <a>another thing</a></p></div>'
    assert text(f"<article><p>{words}</p>{links}</article>") == words
