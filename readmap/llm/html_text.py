"""Main text of web pages: boosted trees over the nodes of the document tree, decoded as a hierarchy.

A page becomes a tree of block elements and of runs of text (what stands in a block without another block in
between; inline elements belong to the run). Each node has features of its subtree (text, density, links,
punctuation), its place (depth, siblings, position), its tag and attribute words and those around it. Gradient-boosted trees,
trained here, give the log-odds that a node holds main text. A node that is dropped drops what is in it, and a
node is only kept inside kept ones: the choice with the highest sum of log-odds under that rule is found from
the leaves up.

Pages carry no labels. The model learns from a bounded sample of them: the text of ``article`` or ``main`` without
what is known to be something else there, and pages put together from that text, in which content and
boilerplate stand in other elements, under other names, and where each piece is known.
"""

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from readmap.llm.common import map_texts

#: Pages that a model is trained on, at most: those with the smallest hash of their id and html, among the pages of so
#: many characters at most.
SAMPLE_PAGES = 300
SAMPLE_CHARS = 100_000
TREES, LEVELS, BINS, RATE = 60, 4, 32, 0.3

# Names of HTML elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements in a line that are nodes of their own, if they have an end tag.
BOXES = frozenset("button select datalist iframe template noscript object canvas audio video".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th"
    " thead tr ul caption".split()
) | BOXES
ENDS_PARAGRAPH = BLOCKS - BOXES - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
KINDS = [
    {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}, {"ul", "ol", "li", "dl", "dt", "dd", "menu"}, {"div", "center"},
    {"article", "main", "section"}, {"nav", "aside", "header", "footer", "search", "dialog", "address"}, {"form", "fieldset", "legend", "button", "select", "datalist"},
    {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"blockquote", "pre", "figure", "figcaption", "details", "summary"},
]
KIND = {tag: number for number, tags in enumerate(KINDS) for tag in tags}
APART, CONTENT = KINDS[5] | KINDS[6], {"article", "main"}

# The rest of a tag. A quote begins a value only after "=", and ends it only where the tag or white space goes on:
# otherwise it is missing its partner, and the tag ends at the next ">".
_REST = r"(?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')(?=[\s/>]|\Z)|=)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|title|textarea)\b{_REST}(?:(?<=/)>|>.*?(?:</\1\s*>|\Z))"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_REST})(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|([^<]+|<)",
    re.S | re.I,
)
_BOX = re.compile(rf"<(/?)({'|'.join(sorted(BOXES))})\b", re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|aria-label|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LABEL = re.compile(r"\bdata-y=\"([01])\"")


class Tree:
    """Nodes in page order: parent, tag (empty for a run of text), attribute words, text, linked characters."""

    __slots__ = ("parent", "tag", "words", "text", "links", "label")

    def __init__(self, page: str):
        self.parent, self.tag, self.words, self.text, self.links = [-1], ["html"], [()], [""], [0]
        self.label: list[int | None] = [None]
        self._parse(page)

    def _add(self, parent: int, tag: str, words=(), text: str = "", links: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.links.append(links)
        self.label.append(None)
        return len(self.tag) - 1

    def _parse(self, page: str) -> None:
        stack = [("html", 0)]  # open elements; inline ones have the node of their block
        run: list[str] = []
        linked = anchors = head = 0
        skipped = ""  # the element of the head whose content is passed over
        closed = self._closed(page)

        def flush():
            nonlocal run, linked
            if run:
                text = " ".join("".join(run).split())
                if text:
                    self._add(stack[-1][1], "", (), text, min(linked, len(text)))
                run, linked = [], 0

        def close(depth: int):
            nonlocal anchors
            if any(tag in BLOCKS for tag, _ in stack[depth:]):
                flush()
            anchors -= sum(tag == "a" for tag, _ in stack[depth:])
            del stack[depth:]

        for token in _TOKEN.finditer(page):
            text = token[5]
            if text is not None:
                if head and not skipped and text.strip():
                    head = 0
                if not head:
                    text = html.unescape(text) if "&" in text else text
                    run.append(text)
                    if anchors:
                        linked += len(text.strip())
                continue
            tag = token[3]
            if tag is None:
                continue
            tag = tag.lower()
            if skipped:
                if tag == "body" or token[2] and tag in (skipped, "head"):
                    skipped = ""
                if tag not in ("body", "head"):
                    continue
            if tag == "head":
                head = not token[2]
                continue
            if tag in BOXES and not token[2] and token.start() not in closed:
                continue
            if head and not token[2] and tag != "html":
                # The tags of the head may be left out: what cannot stand in it ends it.
                if tag in IN_HEAD:
                    skipped = tag if tag in BOXES else ""
                    continue
                head = 0
            if token[2]:
                if tag in ("html", "body"):
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
                    if stack[depth][0] in ("td", "th", "table") and tag not in KINDS[7] and tag in BLOCKS:
                        break
                continue
            if tag == "html":
                continue
            if tag in VOID and tag not in BLOCKS:
                if tag == "br":
                    run.append(" ")
                continue
            if tag not in BLOCKS:
                if not token[4].rstrip().endswith("/"):
                    anchors += tag == "a"
                    stack.append((tag, stack[-1][1]))
                continue
            self._imply(tag, stack, close)
            flush()
            node = self._add(stack[-1][1], tag, self._words(token[4]))
            mark = _LABEL.search(token[4])
            if mark:
                self.label[node] = int(mark[1])
            if tag != "hr":
                stack.append((tag, node))
        flush()

    @staticmethod
    def _closed(page: str) -> set[int]:
        """Places of the start tags of ``BOXES`` that have an end tag of their own."""
        opened: dict[str, list[int]] = {}
        closed = set()
        for tag in _BOX.finditer(page):
            starts = opened.setdefault(tag[2].lower(), [])
            if not tag[1]:
                if tag[2].lower() in ("button", "select"):
                    starts.clear()  # never inside another one
                starts.append(tag.start())
            elif starts:
                closed.add(starts.pop())
        return closed

    @staticmethod
    def _imply(tag: str, stack: list, close) -> None:
        """End elements that the new one ends without an end tag."""
        ends, within = (), ()
        if tag in ("li",):
            ends, within = ("li",), ("ul", "ol", "menu")
        elif tag in ("dt", "dd"):
            ends, within = ("dt", "dd"), ("dl",)
        elif tag in ("td", "th"):
            ends, within = ("td", "th"), ("tr", "table")
        elif tag == "tr":
            ends, within = ("tr",), ("tbody", "thead", "tfoot", "table")
        elif tag in ("tbody", "thead", "tfoot"):
            ends, within = ("tbody", "thead", "tfoot"), ("table",)
        for wanted, limits in ((ends, within), (("p",) if tag in ENDS_PARAGRAPH else (), ("td", "th", "table"))):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in wanted:
                    close(depth)
                    break
                if stack[depth][0] in limits or not wanted:
                    break

    @staticmethod
    def _words(attributes: str) -> tuple[str, ...]:
        if not attributes or "=" not in attributes and "hidden" not in attributes:
            return ()
        found = []
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            if name in ("hidden", "aria-hidden"):
                found += ["hidden"] * (value.lower() != "false")
            elif name == "style":
                found += ["hidden"] * (re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None)
            else:
                found += [w.lower() for w in _WORD.findall(value)]
        return tuple(dict.fromkeys(found))


FEATURES = 31


def features(tree: Tree, weights: dict[str, float]) -> np.ndarray:
    """A row of features for each node. ``weights``: log-odds of attribute words."""
    n, parent = len(tree.tag), tree.parent
    chars = [float(len(t)) for t in tree.text]
    links = [float(x) for x in tree.links]
    marks = [float(t.count(",") + t.count(".") + t.count(";")) for t in tree.text]
    blocks, paragraphs, children = [0.0] * n, [0.0] * n, [0] * n
    total_before, before = 0.0, [0.0] * n
    for i in range(n):
        before[i] = total_before
        total_before += chars[i]
    child_chars = chars[:]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        marks[p] += marks[i]
        is_block = tree.tag[i] != ""
        blocks[p] += blocks[i] + is_block
        paragraphs[p] += paragraphs[i] + (tree.tag[i] == "p")
        children[p] += 1
    total = max(chars[0], 1.0)
    sums, same, order = [0.0] * n, [dict() for _ in range(n)], [0] * n
    seen = [0] * n
    for i in range(1, n):
        p = parent[i]
        sums[p] += chars[i]
        same[p][tree.tag[i]] = same[p].get(tree.tag[i], 0) + 1
        order[i] = seen[p]
        seen[p] += 1
    depth, own, worst, best = [0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    apart, inside = [0] * n, [0] * n
    rows = []
    for i in range(n):
        p, tag = parent[i], tree.tag[i]
        if tree.words[i]:
            known = [weights.get(w, 0.0) for w in tree.words[i]]
            own[i] = min(known) + max(known)
        if i:
            depth[i] = depth[p] + 1
            worst[i], best[i] = min(worst[p], own[i]), max(best[p], own[i])
            apart[i] = apart[p] or tag in APART
            inside[i] = inside[p] or tag in CONTENT
        row = [0.0] * FEATURES
        c, kin = chars[i], children[p] if i else 1
        row[0], row[1], row[2] = c, links[i] / c if c else 0.0, blocks[i]
        row[3], row[4] = c / (blocks[i] + 1), marks[i] / c if c else 0.0
        row[5], row[6], row[7] = depth[i], order[i] / kin, kin
        row[8] = same[p][tag] / kin if i else 1.0
        row[9] = (sums[p] - c) / (kin - 1) if kin > 1 else 0.0
        row[10], row[11] = before[i] / total, c / total
        row[12], row[13], row[14] = own[i], worst[i], best[i]
        if tag:
            if tag in KIND:
                row[15 + KIND[tag]] = 1.0
        else:
            row[24] = 1.0
            if tree.tag[p] in KIND:
                row[15 + KIND[tree.tag[p]]] = 0.5
        row[25], row[26] = apart[i], inside[i]
        row[27] = links[p] / chars[p] if i and chars[p] else 0.0
        row[28] = chars[p] if i else c
        row[29] = paragraphs[i] / (blocks[i] + 1)
        row[30] = child_chars[i]
        rows.append(row)
    return np.array(rows, np.float32)


@dataclass(frozen=True)
class Model:
    """Trees whose levels each compare one feature; a leaf is found by the outcomes as bits."""

    weights: dict[str, float]
    base: float
    chosen: np.ndarray  # trees x levels
    limits: np.ndarray
    leaves: np.ndarray  # trees x 2 ** levels

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base, np.float32)
        columns = np.ascontiguousarray(rows.T)
        for chosen, limits, leaves in zip(self.chosen, self.limits, self.leaves):
            leaf = np.zeros(len(rows), np.int8)
            for level, (feature, limit) in enumerate(zip(chosen, limits)):
                leaf |= (columns[feature] > limit).view(np.int8) << level
            out += leaves[leaf]
        return out


def boost(rows: np.ndarray, labels: np.ndarray, weights: dict[str, float]) -> Model:
    """Gradient boosting for the log-loss, by histograms of binned features."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, rows.T)]).astype(np.int64)
    rate = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(rate / (1 - rate)))
    margin = np.full(len(rows), base)
    chosen, limits, leaves = [], [], []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        gradient, hessian = labels - chance, chance * (1 - chance)
        leaf, features_, limits_ = np.zeros(len(rows), np.int64), [], []
        for level in range(LEVELS):
            parts, best = 1 << level, (-np.inf, 0, 0)
            for feature, e in enumerate(edges):
                if not len(e):
                    continue
                bins = len(e) + 1
                at = leaf * bins + binned[feature]
                g = np.bincount(at, gradient, parts * bins).reshape(parts, bins).cumsum(axis=1)
                h = np.bincount(at, hessian, parts * bins).reshape(parts, bins).cumsum(axis=1)
                left, right = g**2 / (h + 1), (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1)
                gain = (left + right).sum(axis=0)[:-1]
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), feature, k)
            _, feature, k = best
            limit = edges[feature][k] if len(edges[feature]) else np.float32(np.inf)
            leaf |= (rows[:, feature] > limit).astype(np.int64) << level
            features_.append(feature)
            limits_.append(limit)
        g = np.bincount(leaf, gradient, 1 << LEVELS)
        h = np.bincount(leaf, hessian, 1 << LEVELS)
        steps = RATE * g / (h + 1)
        margin += steps[leaf]
        chosen.append(features_)
        limits.append(limits_)
        leaves.append(steps)
    return Model(weights, base, np.array(chosen), np.array(limits, np.float32), np.array(leaves, np.float32))


def decode(tree: Tree, log_odds: np.ndarray) -> list[int]:
    """Kept nodes: the best choice in which nothing is kept inside a dropped node."""
    n, parent = len(tree.tag), tree.parent
    score = log_odds.tolist()
    kept, dropped = score[:], [-s for s in score]  # best value with the node kept, value with all of it dropped
    keep = [True] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        keep[i] = kept[i] > dropped[i]
        kept[p] += max(kept[i], dropped[i])
        dropped[p] += dropped[i]
    keep[0] = kept[0] > dropped[0]
    for i in range(1, n):
        keep[i] = keep[i] and keep[parent[i]]
    return [i for i in range(n) if keep[i]]


def page_text(tree: Tree, log_odds: np.ndarray) -> str:
    """Kept runs of text, one line each."""
    return "\n".join(tree.text[i] for i in decode(tree, log_odds) if tree.text[i])


# Training

# Words that pages use in attributes, for content and for what stands around it.
CONTENT_WORDS = (
    "content article post entry story body text main page copy prose rich single blog news detail markdown read paragraph"
).split()
BOILERPLATE = {
    "nav": "nav navigation menu navbar breadcrumb breadcrumbs topbar links pagination pager toc skip".split(),
    "header": "header masthead banner logo top branding site tagline".split(),
    "footer": "footer copyright legal bottom colophon credits imprint".split(),
    "aside": "sidebar aside widget related recommended promo trending popular recent rail tags teaser more also".split(),
    "notice": "cookie consent notice gdpr modal popup overlay alert newsletter subscribe signup paywall toast privacy hidden".split(),
    "ad": "ad ads advert advertisement sponsor sponsored adsense dfp promoted commercial banner".split(),
    "form": "form search login contact feedback input register".split(),
    "comments": "comment comments reply replies discussion disqus respond thread reader readers user".split(),
    "share": "share social sharing follow buttons tools meta byline author bio print".split(),
}


def _teacher(tree: Tree) -> list[int] | None:
    """Labels of a page's own nodes: runs in ``article`` or ``main``, outside of what is set apart there."""
    n = len(tree.tag)
    inside, apart, y = [False] * n, [False] * n, [0] * n
    known = {w for words in BOILERPLATE.values() for w in words} - {"top", "site", "more", "also", "main", "text", "author", "meta", "user", "reader"}
    for i in range(1, n):
        p = tree.parent[i]
        inside[i] = inside[p] or tree.tag[i] in CONTENT or "main" in tree.words[i]
        apart[i] = apart[p] or tree.tag[i] in APART or (inside[p] and any(w in known for w in tree.words[i]))
        y[i] = int(bool(tree.text[i]) and inside[i] and not apart[i])
    return _spread(tree, y) if any(y) else None


def _spread(tree: Tree, y: list[int]) -> list[int]:
    """A node holds main text if something in it does."""
    for i in range(len(y) - 1, 0, -1):
        y[tree.parent[i]] |= y[i]
    return y


def _composed(blocks: list[str], spare: list[str], dice: random.Random) -> str:
    """A page of other make: ``blocks`` as its content, with boilerplate of ``spare`` texts before, in and after it."""
    def some(low: int, high: int) -> str:
        words = dice.choice(spare).split() or ["x"]
        at = dice.randrange(len(words))
        return html.escape(" ".join((words[at:] + words)[: dice.randint(low, high)]))

    def names(words: list[str]) -> str:
        if dice.random() < 0.15:
            return ""
        picked = dice.choice(words)
        if dice.random() < 0.4:
            picked += dice.choice("- _".split(" ") + ["-"]) + dice.choice(words + ["wrap", "box", "inner", "container"])
        return f' {dice.choice(["class", "class", "id"])}="{picked}"'

    def boilerplate(kind: str) -> str:
        words = BOILERPLATE[kind]
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        attributes = names(words)
        if not attributes and tag in ("div", "section"):
            attributes = f' class="{words[0]}"'
        if attributes and tag != "form" and dice.random() < 0.5:
            tag = dice.choice(["div", "div", "section", "ul" if kind == "nav" else "div"])
        if kind in ("nav", "share") or kind in ("aside", "footer") and dice.random() < 0.5:
            inner = "".join(f'<li><a href="/x">{some(1, 5)}</a></li>' for _ in range(dice.randint(2, 8)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
            if kind == "aside":
                inner = f"<h3>{some(1, 4)}</h3>{inner}"
        elif kind == "form":
            inner = f"<label>{some(1, 5)}</label><input><p>{some(2, 12)}</p><button>{some(1, 2)}</button>"
        elif kind == "comments":
            inner = f"<h3>{some(1, 3)}</h3>" + "".join(
                f'<div class="{dice.choice(["comment", "reply", "comment-body"])}"><p>{some(3, 60)}</p></div>' for _ in range(dice.randint(1, 5))
            )
        else:
            inner = "".join(dice.choice(["<p>{}</p>", "{}", "<div>{}</div>"]).format(some(2, 30)) for _ in range(dice.randint(1, 2)))
            if dice.random() < 0.4:
                inner += f'<a href="/x">{some(1, 4)}</a>'
        return f'<{tag}{attributes} data-y="0">{inner}</{tag}>'

    content = []
    for number, block in enumerate(blocks):
        tag = dice.choice(["h1", "h2"]) if not number and len(block) < 200 else dice.choices(["p", "h2", "li", "blockquote", "div", "td", "pre"], [30, 2 if len(block) < 120 else 0, 1, 1, 1, 0.5, 0.5])[0]
        element = f"<{tag}>{html.escape(block)}</{tag}>"
        wrap = {"li": "<ul>{}</ul>", "td": "<table><tr>{}</tr></table>"}.get(tag, "{}")
        if dice.random() < (0.1 if number else 0.5):  # headings of a few words
            heading = dice.choice(["h1", "h2", "h3"]) if number else "h1"
            content.append(f"<{heading}>{some(1, 7)}</{heading}>")
        content.append(wrap.format(element))
        if dice.random() < 0.04:
            content.append(boilerplate(dice.choice(["ad", "share", "aside", "notice", "form", "nav"])))
    if dice.random() < 0.3:
        content.append(boilerplate(dice.choice(["share", "comments", "aside", "footer", "notice"])))
    if dice.random() < 0.2:
        content.insert(0, boilerplate(dice.choice(["header", "share", "nav", "ad"])))
    tag, attributes = dice.choice([("article", ""), ("main", ""), ("div", names(CONTENT_WORDS)), ("section", names(CONTENT_WORDS)), ("article", names(CONTENT_WORDS)), ("div", "")])
    middle = f'<{tag}{attributes} data-y="1">{"".join(content)}</{tag}>'
    if dice.random() < 0.4:
        middle = f'<{dice.choice(["div", "main", "section"])}{names(CONTENT_WORDS + ["container", "wrapper", "layout", "row"])}>{middle}</{"div"}>'
    before = [boilerplate(k) for k in dice.sample(["header", "nav", "ad", "notice", "form", "aside"], dice.randint(0, 3))]
    after = [boilerplate(k) for k in dice.sample(["comments", "aside", "footer", "share", "notice", "form", "ad", "nav"], dice.randint(0, 4))]
    return "<html><body>" + "".join(before) + middle + "".join(after) + "</body></html>"


def _marked(tree: Tree) -> list[int]:
    """Labels of a composed page: a run's is that of the nearest marked element."""
    mark = [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        mark[i] = mark[tree.parent[i]] if tree.label[i] is None else tree.label[i]
    return _spread(tree, [m if tree.text[i] else 0 for i, m in enumerate(mark)])


def train(pages: list[str], variants: int = 6, seed: int = 1) -> Model:
    """A model from pages and what is composed of their text. Without any, built-in words stand for text."""
    dice, trees, labels = random.Random(seed), [], []
    contents, spare = [], []
    for page in pages:
        tree = Tree(page)
        y = _teacher(tree)
        if y is not None:
            trees.append(tree)
            labels.append(y)
            contents.append([t for t, k in zip(tree.text, y) if t and k])
        spare.extend(t for t in tree.text if t)
    if not contents:
        contents = [["word " * 40, "text, " * 60 + "end.", "more " * 30] for _ in range(20)]
    spare = spare or [" ".join(CONTENT_WORDS)]
    for blocks in contents:
        for _ in range(variants):
            tree = Tree(_composed(dice.sample(blocks, len(blocks)) if dice.random() < 0.3 else blocks[: dice.randint(1, len(blocks))], spare, dice))
            trees.append(tree)
            labels.append(_marked(tree))
    # Attribute words: smoothed log-odds of the nodes that have them.
    counts: dict[str, list[float]] = {}
    for tree, y in zip(trees, labels):
        for words, k in zip(tree.words, y):
            for w in words:
                counts.setdefault(w, [0.0, 0.0])[k] += 1
    weights = {w: float(np.log((b + 1) / (a + 1))) for w, (a, b) in counts.items()}
    rows = np.concatenate([features(tree, weights) for tree in trees])
    return boost(rows, np.concatenate([np.array(y, np.float64) for y in labels]), weights)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Model:
    """Train on at most ``sample_pages`` pages, which reach the driver."""
    order = F.xxhash64("page_id", "html")
    pages = pages.select("page_id", "html").filter((F.col("html") != "") & (F.length("html") <= SAMPLE_CHARS))
    chosen = [row[0] for row in pages.select(order.alias("order")).distinct().orderBy("order").limit(sample_pages).collect()]
    found = pages.filter(order.isin(chosen)).select(order.alias("order"), "html")
    rows = found.dropDuplicates(["order"]).orderBy("order").collect()
    return train([row.html for row in rows])


def extracted(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page, from its whole html.

    ``text`` is the kept blocks in page order, a line each; empty if nothing is kept, and for NULL or empty html.
    ``n_chars`` counts its code points. Rows that repeat an id are pages of their own; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # some kilobytes

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            sources, texts = batch.column("html").to_pylist(), []
            for start in range(0, len(sources), 200):
                trees = [Tree(source or "") for source in sources[start : start + 200]]
                rows = [features(tree, model.weights) for tree in trees]
                odds = np.split(model.log_odds(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                texts.extend(page_text(tree, o) for tree, o in zip(trees, odds))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    pages = pages.select("page_id", "url", "html")
    schema = StructType([*pages.schema.fields[:2], StructField("text", StringType()), StructField("n_chars", LongType())])
    return map_texts(pages, extract, schema)
