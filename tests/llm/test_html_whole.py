import pytest

from readmap.llm.html_text import Tree

# Pages whose text has to reach the trees, and its runs.
SEEN = [
    ("<p>one <button>Go<p>two</p><p>three</p>", ["one Go", "two", "three"]),
    ("<p>one <button>Go</button> end<p>two", ["one", "Go", "end", "two"]),
    ("<button>a<p>b</p><button>c</button><p>d</p>", ["a", "b", "c", "d"]),
    ("<p>one<svg><path d=x><p>two", ["one", "two"]),
    ("<p>so <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds</p>", ["so E=m holds"]),
    ("<article><noscript><p>kept</p></noscript><object>shown</object></article>", ["kept", "shown"]),
    ("<head><title>t</title><meta name=a><p>one<p>two", ["one", "two"]),
    ("<html><head><title>t</title><link rel=x>text<p>two", ["text", "two"]),
    ("<head><noscript><style>x</style><img src=y></noscript><script>z</script></head><body><p>one", ["one"]),
    ("<head><template><p>inert</p></template><title>t</title><div>one</div>", ["one"]),
    ("<p>one<head><p>two", ["one", "two"]),
    ("<p>one<textarea>typed</textarea><script>x</script> two<style>y", ["one two"]),
    ("<p title=it's>Hello world.</p><p>Don't stop</p><p>b</p>", ["Hello world.", "Don't stop", "b"]),
    ('<p class="x>one</p><p>two</p>', ["one", "two"]),
    ("<a href='x>one</a> two", ["one two"]),
    ('<p class="x>one</p><a href="y">two</a>', ["one", "two"]),
    ("<p title='a > b' id=c>one</p><p data-x=\"<b>\">two", ["one", "two"]),
    ('<img alt="5" 6">it\'s</img><p>two', ["it's", "two"]),
    ("<script src='x>1</script><p>one</p>", ["one"]),
    ("<p a=>one</p><p b= >two</p><p c=\"\">three", ["one", "two", "three"]),
    ("<p>one<iframe src=x><p>two</p><video><p>three</p><template><p>four", ["one", "two", "three", "four"]),
]


@pytest.mark.parametrize("page, runs", SEEN)
def test_text_reaches_the_trees(page, runs):
    assert [t for t in Tree(page).text if t] == runs


def test_boxes_are_nodes():
    tree = Tree("<p>one <noscript>two</noscript> three</p>")
    assert tree.tag == ["html", "p", "", "noscript", "", ""] and tree.parent == [-1, 0, 1, 1, 3, 1]
