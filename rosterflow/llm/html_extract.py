"""Main text of web pages by a tree-structured model over their elements."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col, replace_columns, ship, texts_of
from rosterflow.llm.html_tree import Tree, parse_page
from rosterflow.llm.labelled_pages import LABEL, labelled_pages

GROUPS = (
    "html body #page", "main article", "section div center", "p", "h1 h2 h3 h4 h5 h6", "ul ol menu dl", "li dt dd",
    "nav", "header", "footer", "aside", "form fieldset legend search", "table caption thead tbody tfoot tr td th",
    "figure figcaption", "blockquote pre", "address", "details summary dialog hgroup",
)
GROUP_OF = {tag: i for i, tags in enumerate(GROUPS) for tag in tags.split()}
# Words of class, id and role attributes that tell what an element is for.
KINDS = (
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion promoted banner adsense dfp outbrain taboola",
    "nav navbar navigation menu breadcrumb breadcrumbs pager pagination toc toolbar topbar skip sitemap",
    "header masthead site-header branding logo",
    "footer foot bottom copyright legal colophon contentinfo",
    "sidebar side aside widget widgets related recommended recommendations trending popular rail complementary teaser more",
    "share sharing social follow tags byline meta toolbox print",
    "comment comments commentlist reply replies respond disqus discussion feedback reviews",
    "cookie cookies consent gdpr notice notices alert warning message popup modal overlay disclaimer paywall",
    "form newsletter subscribe subscription signup login register search contact survey poll",
    "hidden invisible sr-only screen-reader-text",
)
GOOD = set("article content main post entry story body text articlebody".split())
KIND_OF = {word: i for i, words in enumerate(KINDS) for word in words.split()}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
N_TEXT = 9
N_FEATURES = len(GROUPS) + len(KINDS) + 2 + N_TEXT


def hints(attributes: dict[str, str]) -> tuple[set[int], bool]:
    """Kinds that the attributes of an element name, and whether they name content instead."""
    if not attributes:
        return set(), False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN.search(attributes.get("style", "")):
        return {len(KINDS) - 1}, False
    named = " ".join(attributes.get(a, "") for a in ("class", "id", "role"))
    words = set()
    for name in named.split():
        words.add(name.lower())
        words.update(w.lower() for w in WORD.findall(name))
    kinds = {KIND_OF[w] for w in words if w in KIND_OF}
    return kinds, not kinds and bool(words & GOOD)


def features(tree: Tree) -> np.ndarray:
    """A row per node."""
    x = np.zeros((len(tree.tag), N_FEATURES))
    first_text = len(GROUPS) + len(KINDS) + 2
    for i, (tag, text, attributes) in enumerate(zip(tree.tag, tree.text, tree.attributes)):
        if tag == "#text":
            size, words = len(text), text.count(" ") + 1
            linked = min(1.0, tree.linked[i] / size)
            x[i, first_text:] = (
                1, min(words, 60) / 60, words < 4, linked, linked > 0.6, text[-1] in ".!?…\"”»:", "©" in text,
                min(1.0, text.count(",") / words), min(1.0, text.count("|") / words),
            )
            continue
        x[i, GROUP_OF.get(tag, 0)] = 1
        kinds, good = hints(attributes)
        for kind in kinds:
            x[i, len(GROUPS) + kind] = 1
        x[i, len(GROUPS) + len(KINDS)] = bool(kinds)
        x[i, len(GROUPS) + len(KINDS) + 1] = good
    return x


@dataclass
class TreeModel:
    """Log potentials: ``weight`` of features of a content node; ``pair[kind, parent, child]`` of a parent's and a child's
    labels, where the kind is 0 between elements and 1 above a text."""

    weight: np.ndarray
    pair: np.ndarray

    def messages(self, tree: Tree, x: np.ndarray) -> tuple[list[float], list[tuple[int, int, float, float, float, float]]]:
        """Marginals of content for each node, and of both labels (00, 01, 10, 11) for each edge (child, kind)."""
        n, parent = len(tree.tag), tree.parent
        tables = np.exp(self.pair).reshape(2, 4).tolist()
        kind = [int(t == "#text") for t in tree.tag]
        own = np.exp(np.clip(x @ self.weight, -30, 30))
        low, high = (1 / (1 + own)).tolist(), (own / (1 + own)).tolist()
        up0, up1 = [1.0] * n, [1.0] * n
        for i in range(n - 1, 0, -1):  # from the leaves to the root
            t00, t01, t10, t11 = tables[kind[i]]
            m0, m1 = t00 * low[i] + t01 * high[i], t10 * low[i] + t11 * high[i]
            total = m0 + m1
            up0[i], up1[i] = m0 / total, m1 / total
            p = parent[i]
            a, b = low[p] * up0[i], high[p] * up1[i]
            total = a + b
            low[p], high[p] = a / total, b / total
        down0, down1 = [1.0] * n, [1.0] * n
        edges = []
        for i in range(1, n):  # and back
            p = parent[i]
            t00, t01, t10, t11 = tables[kind[i]]
            k0, k1 = down0[p] * low[p] / up0[i], down1[p] * high[p] / up1[i]
            d0, d1 = t00 * k0 + t10 * k1, t01 * k0 + t11 * k1
            total = d0 + d1
            down0[i], down1[i] = d0 / total, d1 / total
            both = (t00 * k0 * low[i], t01 * k0 * high[i], t10 * k1 * low[i], t11 * k1 * high[i])
            total = sum(both)
            edges.append((i, kind[i], *(v / total for v in both)))
        content = [d1 * h / (d0 * l + d1 * h) for d0, d1, l, h in zip(down0, down1, low, high)]
        return content, edges

    def main_text(self, page: str, least: float = 0.5) -> str:
        tree = parse_page(page)
        content, _ = self.messages(tree, features(tree))
        return "\n".join(t for t, tag, p in zip(tree.text, tree.tag, content) if tag == "#text" and p >= least)


def node_labels(tree: Tree) -> np.ndarray:
    """1 for texts under a node marked as content (the nearest mark counts) and for the elements that hold such texts."""
    marked, y = [0] * len(tree.tag), np.zeros(len(tree.tag), dtype=np.int64)
    for i, attributes in enumerate(tree.attributes):
        inherited = marked[tree.parent[i]] if i else 0
        marked[i] = int(attributes[LABEL]) if LABEL in attributes else inherited
        y[i] = tree.tag[i] == "#text" and marked[i]
    for i in range(len(tree.tag) - 1, 0, -1):
        y[tree.parent[i]] |= y[i]
    return y


def train(pages: list[str], rounds: int = 250, penalty: float = 0.00003, rate: float = 0.2) -> TreeModel:
    """Maximum likelihood of labelled pages, by Adam on gradients from sum-product marginals."""
    examples = []
    for page in pages:
        tree = parse_page(page)
        x, y = features(tree), node_labels(tree)
        seen = np.zeros((2, 2, 2))
        for i in range(1, len(y)):
            seen[int(tree.tag[i] == "#text"), y[tree.parent[i]], y[i]] += 1
        examples.append((tree, x, x.T @ y, seen))
    total = sum(len(tree.tag) for tree, *_ in examples)
    theta = np.zeros(N_FEATURES + 8)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        model = TreeModel(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2, 2))
        gradient = -penalty * theta
        for tree, x, seen_x, seen_pair in examples:
            content, edges = model.messages(tree, x)
            expected = np.zeros((2, 4))
            for _, kind, *both in edges:
                expected[kind] += both
            gradient[:N_FEATURES] += (seen_x - x.T @ np.array(content)) / total
            gradient[N_FEATURES:] += (seen_pair.ravel() - expected.ravel()) / total
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return TreeModel(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2, 2))


@cache
def default_model() -> TreeModel:
    """The model of the labelled pages of this package."""
    return train(labelled_pages())


def extract_main_text(pages: DataFrame, model: TreeModel | None = None, least: float = 0.5, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of the whole page, and ``n_chars``, its code points.

    The nodes of the model are block elements and, as leaves, the runs of text between their tags. Each is content or
    not: a node's potential follows from its tag, attributes and text, and a pair potential ties it to its parent.
    Sum-product messages up and down the tree give exact marginals, and the runs with a marginal of ``least``
    or more make the text: references decoded, white space as single spaces, one run a line, in page order.
    Scripts, styles and the like never count.

    A null or empty page, and one without main text, has an empty text. Rows are extracted one by one. Columns
    named like the new ones are replaced. An empty table stays empty.
    """
    ship(pages.sparkSession)
    model = model or default_model()

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.main_text(t, least) for t in texts_of(batch)], pa.string())

    found = replace_columns(pages, {"text": extract(col(html_column).cast("string"))})
    return replace_columns(found, {"n_chars": F.char_length("text").cast("long")})
