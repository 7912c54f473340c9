import pytest

from trustline.llm.html import Page, extract


def test_tree_judges_the_leaves_of_an_article(spark):
    rows = []
    for i in range(8):
        own = f"<h1>Title {i}</h1><p>Text {i} of its own.</p><h2>Summary</h2><p>And more {i}.</p>"
        rows.append((i, f"http://a.example/{i}", f"<div>line {i}</div><article>{own}<h2>Follow us</h2><p>Sign up for our letter.</p></article><div>foot</div>"))
        copy = "<p>One text that all mirrors of this page have.</p><p>Its second part.</p>"
        rows.append((100 + i, f"http://b.example/{i}", f"<article><p>No. {i}</p>{copy}</article>"))
    got = {r.id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i} Text {i} of its own. Summary And more {i}." for i in range(8))
    assert all(got[100 + i] == f"No. {i} One text that all mirrors of this page have. Its second part." for i in range(8))


def test_tree_has_what_is_outside_the_article():
    page = Page("<div class='a'>before</div><article><p>text</p></article><p>after</p>")
    assert len(page.blocks) == 3 and len(list(page.nodes())) == 3
    assert page.text(set()) == "text"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<article><h1 class="page-header">T</h1><h2 id="related-work">Work</h2><p id="search">a</p></article>', "T Work a"),
        ('<article><h1>T</h1><section id="discussion"><h2>D</h2><p>b</p></section><h3 id="legal-status">L</h3><h2 id="search">S</h2></article>', "T D b L S"),
        ('<article><p>a longer text</p><div class="social-impact">c</div><pre>x <span class="comment">y</span></pre></article>', "a longer text c x y"),
        ('<div class="content no-sidebar"><p>d</p></div><div class="nav-collapsed">e</div>', "d e"),
        ('<div class="widget"><p>nearly all of the text</p></div><p>f</p>', "nearly all of the text f"),
        ('<p>the text of the page</p><div class="site-footer cookie-notice">g</div><div id="sidebar">h</div>', "the text of the page"),
        ('<div>the text</div><article class="comment">i</article>', "the text"),
    ],
)
def test_names_count_only_as_a_whole(html, text):
    assert Page(html).text(set()) == text


def test_importance_confirms_names(spark):
    rows = [(i, f"http://a.example/{i}", f"<article><p>A long text of page {i}.</p><div class='widget'>chart {i}</div><div class='promo'>Buy!</div></article>") for i in range(8)]
    rows.append((100, "http://lone.example/", rows[0][2]))
    got = {r.id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"A long text of page {i}. chart {i}" for i in range(8))
    assert got[100] == "A long text of page 0."
