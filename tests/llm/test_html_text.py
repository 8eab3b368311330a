import re

from beaconry.llm import html_text as ht
from beaconry.session import read_table

ARTICLE = "<p>A first sentence, which is long enough; it says something. And a second one follows it.</p>"


def test_article_alone():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav>"
            "<!-- ad --><div class=\"ad\">Buy this now, it is cheap. Really, it is!</div><article><h1>Title &amp; more</h1><p><b>Unclosed   bold\n one.<br>next<p>Two.</p>"
            "<ul><li>point <i>a</i></li><li>point b</li></ul></article><aside>Side text, long. Long.</aside><footer>&copy; me &middot; x</footer></body></html>")
    assert ht.main_text(page) == "Title & more\nUnclosed bold one. next\nTwo.\npoint a\npoint b"


def test_without_an_article_tag():
    page = ("<body><div id=\"top-menu\"><a href=a>One</a> <a href=b>Two</a></div><div class='cookie-notice'>We use cookies, you know. Accept them.</div>"
            f"<div class=content><h2>Heading</h2>{ARTICLE * 3}</div><ul><li><a href=1>x</a><li><a href=2>y</a></ul>"
            "<div class=\"comments\"><p>I read it, and liked it. Very much so, thank you.</p></div><form><p>Your name, please.</p></form></body>")
    assert ht.main_text(page) == "\n".join(["Heading", *["A first sentence, which is long enough; it says something. And a second one follows it."] * 3])


def test_edges():
    for empty in (None, "", "   ", "<p></p>", "<script>x", "<!-- open", "<nav>a", "<"):
        assert ht.main_text(empty) in ("", "<")
    assert ht.main_text("plain text &lt;here&gt;, no tags.") == "plain text <here>, no tags."
    assert ht.main_text("<article><p>a < b and c d</article>").startswith("a < b and c d")
    assert ht.main_text("<article>" + "<p>x.</p>" * 5000 + "</article>").count("\n") == 4999
    assert ht.main_text("<article>" + "<div>" * 3000 + "deep, it is.") == "deep, it is."


def test_pages(spark):
    """Against what the pages' own structure says: their articles."""
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in ht.extract(pages).collect()}
    import html as h
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = [" ".join(h.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", part))).split()) for part in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(w for w in want if w) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_table_edges(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>x.</p>", 2), (1, "u", "<p>x.</p>", 2)], "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in ht.extract(df).collect()) == [(0, "", 0), (1, "x.", 2), (1, "x.", 2)]
    assert ht.extract(df.limit(0)).collect() == []


def test_ratios_decide_with_a_marked_article():
    text = "A first sentence, which is long enough; it says something. And a second one follows it."
    body = f"<div class=text>{ARTICLE * 6}</div>"
    assert ht.main_text(f"<body><article><p>Teaser, short.</p></article>{body}</body>").count(text) == 6
    long = f"<p>{' '.join([text] * 4)}</p>"
    inside = ht.main_text(f"<article><h1>Head</h1>{long * 6}<div class=u>To it</div><div class=v><a href=1>Buy</a> it</div><div class=w>Now</div></article>")
    assert "Buy it" not in inside and inside.startswith("Head\n") and inside.count(text) == 24


def test_raw_elements_end_where_they_end():
    for raw in ('<svg viewBox="0 0 1 1"/>', '<script src="x"/>', "<noscript>", "<style>p{}"):
        assert ht.main_text(f"<body>{raw}{ARTICLE}</body>").startswith("A first"), raw
    assert ht.main_text('<script src="x"/></script><p>Text.</p><script>no</script>') == "Text."
    assert "Caption, of it." in ht.main_text(f"<article>{ARTICLE}<figure><figcaption>Caption, of it.</figcaption></figure></article>")


def test_ratios_decide_without_marks():
    """What no tag or class names: a short block goes, a list of short entries stays."""
    body = f"<div class=c>{ARTICLE * 4}</div>"
    assert ht.main_text(f"<body>{body}<div class=x><span>junk</span></div></body>").count("\n") == 3
    assert "junk" in ht.main_text(f"<body>{body}<div class=x><span>junk</span></div></body>", ratios=False)
    listed = f"<body><div class=c>{ARTICLE * 2}<ul><li>point a</li><li>point b</li></ul>{ARTICLE}</div><ul><li><a href=1>Other page</a></li><li><a href=2>More</a></li></ul></body>"
    assert "point a\npoint b" in ht.main_text(listed) and "Other page" not in ht.main_text(listed)
    terms = f"<article>{ARTICLE * 3}<dl><dt>Key<dd>Val</dl></article>"
    assert ht.main_text(terms).endswith("Key\nVal")


def test_class_names_count_whole():
    long = "<p class='legal-history'>" + "The law was passed, and then changed. It held for long; nobody knew why. So it stood.</p>"
    assert "The law was passed" in ht.main_text(f"<article>{ARTICLE}{long}</article>")
    for name in ("legal", "cookie-notice", "siteHeader", "comments_section", "ad-slot-3", "x sidebar"):
        assert ht.names_other(name), name
    for name in ("legal-history", "adventure", "loading", "article-header", "commentary", "shared-note", "", "13"):
        assert not ht.names_other(name), name


def test_broken_pages_take_time_by_length():
    import time

    n = 300_000
    pages = ("<a " * n, "<script>x" * n, "<a '" * n, "<p " * n + ">", "</x" * n, "<!-" * n, "<div>" * (n // 10) + "</x>" * n, "<b>" * n + "<p>x" * n,
             "<div class='" * n, "<style>" * n + "</style", "&" * n, "<li>" * n, "<svg/>" * n, "</script" * n)
    for page in pages:
        began = time.time()
        ht.main_text(page)
        assert time.time() - began < 15, page[:20]


def test_other_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "u", "<p>x.</p>", "a", 5)], "page_id long, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in ht.extract(df).collect()] == [(1, "u", "x.", 2)]
