import html
import random
import re

import pytest

from readmap.llm import html_text as ht
from readmap.llm.common import table


@pytest.fixture(scope="module")
def model(spark, sf):
    return ht.fit(table(spark, sf, "pages"))


def article(page):
    """What the given pages have in their article, read without a tree."""
    inner = page[page.index("<article>") + 9 :].split("</article>")[0]
    parts = re.split(r"</?(?:h1|p)>", inner.replace("<br>", " "))
    lines = [" ".join(html.unescape(re.sub("<[^>]+>", "", p)).split()) for p in parts]
    return "\n".join(x for x in lines if x)


def extract(model, page):
    tree = ht.Tree(page)
    return ht.page_text(tree, model.log_odds(ht.features(tree, model.weights)))


def test_given_pages(spark, sf, model):
    sf = sf.replace("sf0.001", "sf0.01")
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    rows = ht.extracted(table(spark, sf, "pages"), model).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_other_makes_of_page(model, spark, sf):
    pages = [r.html for r in table(spark, sf.replace("sf0.001", "sf0.1"), "pages").filter("page_id >= 2400").collect()]
    dice, wrong = random.Random(99), 0
    for page in pages:
        tree = ht.Tree(page)
        blocks = [t for t, k in zip(tree.text, ht._teacher(tree)) if t and k]
        made = ht.Tree(ht._composed(blocks, [t for t in tree.text if t], dice))
        want = "\n".join(t for t, k in zip(made.text, ht._marked(made)) if t and k)
        wrong += ht.page_text(made, model.log_odds(ht.features(made, model.weights))) != want
    assert wrong <= 0.1 * len(pages)


PAGE = """<html><head><title>Site</title></head><body><div id="top-menu"><ul><li><a href=x>Home</a></li><li><a href=y>About
us</a></li></ul></div><div class="cookie-banner">We use cookies. <button>OK</button></div><div class="layout"><div class="post-body">
<h1>Title here</h1><p>First paragraph with some words, and more words in it. It goes on.<p>Second &amp; last one&nbsp;with <a href=z>a
link</a> inside it, and a few more words &lt;here&gt;.</p><script>var x = "<p>no</p>";</script><ul><li>point one of the list<li>point two of the
list</ul></div><aside class="sidebar"><h3>Related</h3><p>Some teaser text here</p></aside></div><div class="comments"><h2>Comments</h2>
<div class="comment"><p>I like it very much, thanks for writing.</p></div></div><footer>Copyright 2020</footer></body></html>"""


def test_page_without_article(model):
    assert extract(model, PAGE).split("\n") == [
        "Title here",
        "First paragraph with some words, and more words in it. It goes on.",
        "Second & last one with a link inside it, and a few more words <here>.",
        "point one of the list",
        "point two of the list",
    ]


def test_tree():
    tree = ht.Tree('<div class="a-b fooBar" id=c><p>one<br>two <b>x</b><p>three</div><!-- <p>no --> tail <a href="q>r">link</a>')
    assert [t for t in tree.text if t] == ["one two x", "three", "tail link"]
    assert tree.words[1] == ("a", "b", "foo", "bar", "c") and tree.links[-1] == 4


def test_decoding_is_a_hierarchy():
    dice = random.Random(4)
    for _ in range(200):
        tree = ht.Tree("<div>a<div>b<p>c</p></div><p>d</p></div><p>e</p>")
        odds = [dice.uniform(-2, 2) for _ in tree.tag]
        kept = set(ht.decode(tree, ht.np.array(odds)))
        assert all(i == 0 or tree.parent[i] in kept for i in kept)

        def value(chosen):
            return sum(o if i in chosen else -o for i, o in enumerate(odds))

        best = -1e9
        for bits in range(1 << len(odds)):
            chosen = {i for i in range(len(odds)) if bits >> i & 1}
            if all(i == 0 or tree.parent[i] in chosen for i in chosen):
                best = max(best, value(chosen))
        assert abs(value(kept) - best) < 1e-5


def test_unusual_rows(spark, model):
    data = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (1, "u", "plain text"), (3, "u", "<" * 5000), (4, "u", "</div></p><a><b" * 500), (5, "u", "<div>" * 3000 + "x")]
    pages = spark.createDataFrame([(*d, "t") for d in data], "page_id long, url string, html string, text string")
    rows = ht.extracted(pages, model).collect()
    assert len(rows) == len(data) and all(r.text is not None and r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id in (2, None)} == {""}
    assert ht.extracted(pages.limit(0), model).collect() == []


def test_model_without_pages(spark):
    model = ht.fit(spark.createDataFrame([(1, None)], "page_id long, html string"))
    assert isinstance(extract(model, PAGE), str)
