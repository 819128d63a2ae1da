"""Main text: the tree, whole pages of known structure, odd markup."""

import html
import re

from pricewise.llm import htmltext

TREE = htmltext.grow(*htmltext.labelled())


def known(page):
    """Main text of the given pages' one layout: blocks of the article."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", q.replace("<br>", " ")))).strip() for q in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: known(r.html) for r in pages.collect()}
    rows = htmltext.extract(pages).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows) and len(rows) == pages.count()


def test_grow_on_a_table_of_its_own():
    import numpy as np
    x = np.array([[1.0, 5.0], [2.0, 5.0], [3.0, 1.0], [4.0, 1.0], [2.0, 1.0]])
    y = np.array([0, 0, 1, 1, 0])
    tree = htmltext.grow(x, y)
    assert (tree.feature, tree.cut) == (0, 2.5) and [htmltext.classify(tree, tuple(r)) for r in x] == y.tolist()
    assert htmltext.grow(x[:2], y[:2]).label == 0


def test_parts_beside_the_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><a href=/>Site</a> Motto of the site</header><div id="cookie-notice">We use cookies on this site to give you a good time, accept them all.</div>
    <div class="left-sidebar"><p>About the author a long text with many words that is not the article at all.</p></div>
    <main><header><h1>Title &amp; more</h1></header><p>First   para&nbsp;graph with <a href="x>y">a link</a>
    and&#32;words.</p><ul><li>One <b>it</b>em<li>Two</ul>
    <form><label>Mail address to which we send</label><input></form><script>if (a<b) x("</p>")</script><!-- <p>no</p> -->
    <aside>Other things that you could read on this fine site some day when there is time.</aside>
    <section class="comments"><article class="comment"><p>I liked this article very much, thanks for it, says a reader.</p></article></section></main>
    <footer>All rights to this text are reserved by the people who own the site and its text.</footer></body></html>"""
    assert htmltext.main_text(page, TREE) == "Title & more\n\nFirst para graph with a link and words.\n\nOne item\n\nTwo"


def test_page_without_an_article():
    long = " ".join(f"w{i}" for i in range(30))
    page = f"<div><a href=1>Home</a><a href=2>News</a></div><h2>A headline here</h2><p>{long}</p><p>Short one.</p><p>{long}.</p><div>Copyright me</div>"
    assert htmltext.main_text(page, TREE) == f"A headline here\n\n{long}\n\nShort one.\n\n{long}."


def test_broken_markup_ends():
    for page in ("", "<", "<p", "<!-- a", "a < b <c", "<article>a <b c='x>d</b></article>", "<article><p>x" + "<a" * 20_000, "<article>" + "<div>" * 5_000 + "deep", "</p></div>x", "<script>x"):
        assert isinstance(htmltext.main_text(page, TREE), str)
    assert htmltext.main_text("<article>" + "<div>" * 3_000 + "deep text", TREE) == "deep text"


def test_edge_cases(spark):
    body = "<article><p>" + "Wört &amp; " * 60_000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", body), (3, "u", body), (None, "n", "<article>x  y</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as text", "1 as n_chars")
    out = htmltext.extract(pages).collect()
    by = {r.page_id: r for r in out}
    assert len(out) == 5 and by[1].text == by[2].text == "" and by[1].n_chars == 0
    assert by[3].text == ("Wört & " * 60_000).strip() and by[None].text == "x y"
    assert htmltext.extract(pages.limit(0)).collect() == []


def text_of(page):
    return htmltext.main_text(page, TREE)


def test_names_that_only_look_like_parts_beside():
    long = " ".join(f"w{i}" for i in range(30))
    assert text_of(f'<article class="post comments-open"><h2 id="search">Search</h2><p>{long}</p><section id="related-work"><h2 id="social-history">Past</h2><p>Short.</p></section></article>') \
        == f"Search\n\n{long}\n\nPast\n\nShort."
    assert text_of(f'<article class="sponsored-none"><p>One.</p><div class="related-posts"><p>{long}</p></div></article>') == "One."
    assert text_of(f'<div class="post-meta">By A</div><div class="entry-header">On Monday</div><div class="x"><p>{long}</p></div>') == long
    assert text_of(f'<div class="post">By A</div><div class="x"><p>{long}</p></div>').endswith(long)


def test_short_blocks_unspaced_scripts_and_link_lists():
    rows = [f"a{i} b{i} c{i} d{i} e{i}" for i in range(8)]
    assert text_of("<div>" + "".join(f"<p>{r}</p>" for r in rows) + "</div><div>Copyright me</div>") == "\n\n".join(rows)
    assert text_of("<ul>" + "".join(f"<li>{r}</li>" for r in rows) + "</ul>") == "\n\n".join(rows)
    assert text_of("<table>" + "".join(f"<tr><td>{r}</td></tr>" for r in rows) + "</table>") == "\n\n".join(rows)
    chinese = "这是一个没有空格的中文段落它应该被当作正文而不是被丢掉因为它很长"
    assert text_of(f"<div><p>{chinese}</p></div>") == chinese
    links = "".join(f"<li><a href=/{i}>Source {i}</a></li>" for i in range(3))
    assert text_of(f"<article><p>See:</p><ul>{links}</ul><nav><a href=/>Home</a></nav></article>") == "See:\n\nSource 0\n\nSource 1\n\nSource 2"
