"""Main text of pages by a tree-structured graphical model.

Every DOM node has a hidden label, content or not. Node potentials are a logistic function of indicator features,
parent-child potentials the chance of each label given the parent's; both are trained from labelled pages.
Sum-product messages pass once upward and once downward through the tree, which gives each node's exact marginal;
text blocks whose marginal of being content reaches one half are the main text.

Labelled pages come from two places: pages of the table itself that mark their article with an ``<article>``
element (its text is content, but for parts that are navigation or furniture by tag or name), at most
``max_pages`` of them by smallest hash of the page and of ``max_bytes`` bytes at most; and the short pages of ``SEED_PAGES``, which show kinds of
furniture that a crawl of one kind of page may lack. Training needs only counts, of pairs of labels and of each set of
features with each label, and a regression over those sets.

Any text is a page, however broken (see ``html_tree``). Text: character references are decoded, white space inside a block (line breaks too) becomes one space, blocks are
joined by a newline in page order. Nothing is cut. Null, empty and text-free pages give the empty text. Repeated rows
give equal rows; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookfold.llm.common import arrow_rows, only
from bookfold.llm.html_tree import CONTROLS, FURNITURE, NAVIGATION, Node, node_features, parse_page

_ROWS = 128
_FURNITURE_TAGS = NAVIGATION | CONTROLS
_PROSE = "The committee met again in spring, and its members agreed that the work should go on as it had begun; nobody spoke against the plan."
_SHORT = "Thanks, this was useful."

#: Labelled pages: an article between the kinds of furniture that pages carry.
SEED_PAGES = tuple(
    f"<html><body><header class='site-header'><p>Site name</p></header><div class='{menu}'><ul><li><a href='/'>Home</a></li><li><a href='/b'>About us</a></li></ul></div>"
    f"<{box}><h1>Title of the piece</h1><p>{_PROSE}</p>{inner}<p>{_PROSE} {_PROSE}</p><ul><li>A first point of the piece.</li></ul><p>{_PROSE}</p></{box.split()[0]}>"
    f"<div class='{side}'><p>{_PROSE}</p></div><section class='{talk}'><h2>Comments</h2><p>{_SHORT}</p><p>{_PROSE}</p></section>"
    f"<form><label>Mail</label><p>Sign up for our letter, sent every week.</p></form><footer><p>{_SHORT} All rights reserved.</p></footer></body></html>"
    for box in ("article", "main", "article class='post'")
    for menu, side, talk in (("menu", "sidebar", "comments"), ("navbar", "cookie-notice", "comment-list"), ("nav", "advert", "replies"))
    for inner in ("", f"<div class='ad'>{_SHORT}</div>", f"<aside><p>{_PROSE}</p></aside>", f"<div class='comments'><p>{_PROSE}</p></div>")
)


@dataclass(frozen=True)
class ContentModel:
    """Log potentials: ``weights`` by feature (content against not), ``edges[parent label][label]`` between elements, and
    ``text_edges`` from an element to its text blocks (``edges`` if not given)."""

    weights: dict[str, float]
    edges: tuple[tuple[float, float], tuple[float, float]]
    text_edges: tuple[tuple[float, float], tuple[float, float]] | None = None


def page_labels(nodes: list[Node]) -> list[bool]:
    """Labels of a page that marks its article: below an article element and not below furniture."""
    inside, outside = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        parent = node.parent
        furniture = node.tag in _FURNITURE_TAGS or bool(node.names & FURNITURE) or node.hidden
        outside[i] = furniture or (parent >= 0 and outside[parent])
        inside[i] = node.tag in ("article", "main") or (parent >= 0 and inside[parent])
    return [a and not b for a, b in zip(inside, outside)]


def train_content_model(pages: list[tuple[list[Node], list[bool]]], steps: int = 30, penalty: float = 0.1) -> ContentModel:
    """Node weights by penalised logistic regression (Newton steps), edge potentials by smoothed counts."""
    places: dict[str, int] = {}
    counts: dict[tuple[int, ...], list[int]] = {}
    pairs = np.ones((2, 2, 2))  # by text block or element, parent's label, label
    for nodes, marks in pages:
        for node, mark in zip(nodes, marks):
            held = tuple(places.setdefault(f, len(places)) for f in node_features(node))
            counts.setdefault(held, [0, 0])[mark] += 1
            if node.parent >= 0:
                pairs[int(node.text is not None), int(marks[node.parent]), int(mark)] += 1
    x = np.zeros((len(counts), len(places) + 1))
    x[:, -1] = 1
    for at, row in enumerate(counts):
        x[at, list(row)] = 1
    content, n = np.array([c[1] for c in counts.values()], float), np.array([sum(c) for c in counts.values()], float)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (content - n * p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    # Labels given the parent's; nodes then add what their features say beyond the share of content.
    given = np.log(pairs / pairs.sum(axis=2, keepdims=True))
    share = (content.sum() + 1) / (n.sum() + 2)
    weights = {name: float(w[at]) for name, at in places.items()} | {"": float(w[-1] - np.log(share / (1 - share)))}
    return ContentModel(weights, *(tuple(map(tuple, table)) for table in given.tolist()))


def content_marginals(nodes: list[Node], model: ContentModel) -> list[float]:
    """Each node's log odds of being content, by one upward and one downward pass of messages."""
    weights, bias = model.weights, model.weights.get("", 0.0)
    tables = [tuple(math.exp(v) for row in edges for v in row) for edges in (model.edges, model.text_edges or model.edges)]
    table = [tables[n.text is not None] for n in nodes]
    count = len(nodes)
    own = [bias + sum(weights.get(f, 0.0) for f in node_features(n)) for n in nodes]
    below, message = own[:], [0.0] * count  # log odds of a node with all below it; its message to the parent
    for i in range(count - 1, 0, -1):
        message[i] = _passed(below[i], *table[i])
        below[nodes[i].parent] += message[i]
    odds = below[:]
    for i in range(1, count):
        parent = nodes[i].parent
        # What the parent knows without this child, sent through the same table the other way.
        e00, e01, e10, e11 = table[i]
        odds[i] = below[i] + _passed(odds[parent] - message[i], e00, e10, e01, e11)
    return odds


def _passed(odds: float, to0_from0: float, to0_from1: float, to1_from0: float, to1_from1: float) -> float:
    p = 1.0 / (1.0 + math.exp(-min(max(odds, -40.0), 40.0)))
    return math.log((to1_from0 * (1 - p) + to1_from1 * p) / (to0_from0 * (1 - p) + to0_from1 * p))


def extract_text(html: str | None, model: ContentModel) -> str:
    nodes = parse_page(html)
    if len(nodes) == 1:
        return ""
    odds = content_marginals(nodes, model)
    return "\n".join(n.text for n, o in zip(nodes, odds) if n.text is not None and o >= 0)


def labelled_pages(pages: DataFrame, html_column: str = "html", max_pages: int = 400, max_bytes: int = 100_000) -> list[tuple[list[Node], list[bool]]]:
    """Trees and labels of at most ``max_pages`` pages of at most ``max_bytes`` bytes with an article element, and of the
    seed pages: so many bytes come to the driver at most."""
    rows = only(pages, html=html_column).filter(F.col("html").contains("<article") & (F.octet_length("html") <= max_bytes)).withColumn("place", F.xxhash64("html"))
    # Hashes are chosen first: no page travels but the few that are taken.
    chosen = [r["place"] for r in rows.select("place").distinct().orderBy("place").limit(max_pages).collect()]
    taken = rows.filter(F.col("place").isin(chosen)).groupBy("place").agg(F.min("html").alias("html"))
    sample = [r["html"] for r in taken.orderBy("place").collect()]
    trees = [parse_page(html) for html in [*sample, *SEED_PAGES]]
    return [(nodes, page_labels(nodes)) for nodes in trees]


def extract_main_text(pages: DataFrame, model: ContentModel, html_column: str = "html") -> DataFrame:
    """Columns page_id, url and text."""
    rows = only(pages, page_id="page_id", url="url", html=html_column)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, _ROWS):
            texts = pa.array([extract_text(h, model) for h in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
