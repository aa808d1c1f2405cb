"""The main text of web pages by minimum-cut labelling.

Each block of a page gets the log odds that it is content from a classifier. They become the capacities to the two
terminals; edges between neighbours in page order and between neighbours under one parent, stronger the
closer the blocks are in the tree, make a change of label cost. The minimum cut labels all blocks at once.

The classifier is logistic. What an element's name, class or id says counts with a fixed weight, the innermost that says
anything. Inside an element that is boilerplate by its name all is boilerplate (a form may hold the whole page, so content in it
counts). A class or id weighs less, so that text and neighbours can outweigh it, and an article or main inside overrides it; a
boilerplate word counts only as the whole mark or its last word, and little as its first. The weights of the text itself
(length, links, punctuation and so on) begin at documented values and are fitted on the blocks of a bounded sample of pages whose
own elements tell the label.

Defined results: a null or empty page has an empty text. Nothing is cut off: all blocks with the label content
are joined by \\n in page order, whatever their number. Rows stay one to one with the input.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vedrina.llm.batches import parts
from vedrina.llm.html_blocks import HEADINGS, Block, Element, parse
from vedrina.shared import new_path, written

# Words in class and id names, and element names.
BOILER_NAMES = {"nav", "footer", "header", "aside", "form", "menu", "dialog", "fieldset"}
CONTENT_NAMES = {"article", "main"}
BOILER_MARKS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside rail footer foot header masthead topbar banner ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login register form search comment comments commentlist disqus reply replies respond discussion "
    "share sharing social related recommended recommendations more trending popular widget widgets pagination pager toolbar copyright legal disclaimer "
    "hidden skip complementary contentinfo tags tagcloud byline author-bio".split()
)
CONTENT_MARKS = set("article articlebody content maincontent main post postbody entry story storybody body text page-content".split())
# What a name or a content mark weighs, a boilerplate mark, and a mark that only begins with a boilerplate word.
HINT, MARK_HINT, WEAK_HINT = 6.0, 4.0, 2.0
# Marks of elements that hold other parts of the page.
WRAPPERS = set("wrap wrapper container outer inner row grid layout page site".split())

FEATURES = ["bias", "length", "links", "punctuation", "sentence", "list item", "heading", "few words"]
# Where the fit begins, and stays if no page tells its labels.
PRIOR = np.array([0.3, 0.9, -3.5, 0.6, 0.8, -0.6, 0.2, -0.6])
PRIOR_PRECISION = 20.0
SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 20_000

NEXT, SIBLING = 0.8, 0.5

_MARK = re.compile(r"[a-z]+")
_PARTS = re.compile(r"[\s_]+")
# Marks that tell what the page has besides, or how a post is filed, as in "with-sidebar" and "category-social".
_BESIDES = ("no-", "has-", "with-", "without-", "is-", "text-", "category-", "cat-", "tag-", "type-", "format-", "layout-")


def mark_pull(element: Element) -> float:
    """What the class, id and role say: above 0 for content, below for boilerplate."""
    sure = weak = content = wrapper = False
    for mark in _PARTS.split(element.marks):
        words = _MARK.findall(mark)
        if not words or mark.startswith(_BESIDES):
            continue
        if mark in BOILER_MARKS or words[-1] in BOILER_MARKS:
            sure = True
        elif words[0] in BOILER_MARKS:
            weak = True
        elif mark in CONTENT_MARKS or (CONTENT_MARKS.intersection(words) and not BOILER_MARKS.intersection(words)):
            content = True
        wrapper = wrapper or mark in WRAPPERS
    if sure:
        return -WEAK_HINT if content else -MARK_HINT
    if content:
        return HINT
    return -WEAK_HINT if weak and not wrapper else 0.0


def _pulls(elements: list[Element], elsewhere: bool) -> tuple[list[float], bool]:
    """The pull of each element, and whether any content stands outside boilerplate. ``elsewhere``: it does."""
    found = [0.0] * len(elements)
    # Inside boilerplate by a mark (1), by a mark within content (2), by a name (3).
    inside = [0] * len(elements)
    any_open = False
    for number, element in enumerate(elements[1:], 1):
        around, within = found[element.parent], inside[element.parent]
        name = element.name
        if within == 3:
            found[number], inside[number] = around, 3
            continue
        if name in BOILER_NAMES and not (name == "header" and around > 0 and not element.marks):
            found[number], inside[number] = -HINT, within if name == "form" else 3
            continue
        own = mark_pull(element) if name not in ("html", "body") else 0.0
        named = name in CONTENT_NAMES
        if within:
            found[number], inside[number] = around, within
            if name == "main" and own >= 0:
                found[number], inside[number], any_open = HINT, 0, True
            elif named and own >= 0 and within == 1:
                # The page's own article, or one besides it, of which its text decides.
                found[number], inside[number] = (0.0, within) if elsewhere else (HINT, 0)
            elif own > 0 and within == 1 and not elsewhere:
                found[number] = max(around, -WEAK_HINT)
            continue
        if named or own > 0:
            found[number], any_open = HINT, True
        elif own <= -MARK_HINT:
            found[number], inside[number] = min(own, around), 2 if around > 0 else 1
        elif own < 0:
            # Weak marks inside one another add up.
            found[number] = min(around, max(min(around, 0.0) + own, -MARK_HINT))
        else:
            found[number] = around
    return found, any_open


def pulls(elements: list[Element]) -> list[float]:
    """For each element what it and those around it say, as a gain: below 0 inside any that is boilerplate by name, else what
    the innermost says. A main inside boilerplate by class or id is content, and so is an article unless the page has content
    elsewhere (then its text decides) or the boilerplate is a part of the content (as comments are). A header inside an
    article that says nothing else belongs to the article."""
    found, elsewhere = _pulls(elements, True)
    return found if elsewhere else _pulls(elements, False)[0]


def hints(elements: list[Element]) -> list[int]:
    """For each element 1: content, -1: boilerplate, 0: nothing is said."""
    return [(pull > 0) - (pull < 0) for pull in pulls(elements)]


def features(elements: list[Element], block: Block) -> list[float]:
    text = block.text
    n = len(text)
    words = text.count(" ") + 1
    marks = sum(text.count(mark) for mark in ".,;:?!")
    name = elements[block.element].name
    return [
        1.0,
        min(np.log1p(n) - 3.5, 3.0),
        min(1.0, block.link_chars / n),
        min(1.0, 10 * marks / words) - 0.5,
        1.0 if text[-1] in ".?!\"”»)" else 0.0,
        1.0 if name in ("li", "td", "th", "dt", "dd") else 0.0,
        1.0 if name in HEADINGS else 0.0,
        1.0 if words < 5 else 0.0,
    ]


# --- the cut ------------------------------------------------------------------------------------


def proximity(elements: list[Element], a: int, b: int) -> float:
    """1 in one element, less for each step between the two in the tree."""
    steps = 0
    while a != b and steps < 32:
        if elements[a].depth >= elements[b].depth:
            a = elements[a].parent
        else:
            b = elements[b].parent
        steps += 1
    return 1.0 / (1.0 + steps)


def edges_of(elements: list[Element], blocks: list[Block]) -> list[tuple[int, int, float]]:
    found = []
    last: dict[int, int] = {}  # by parent
    for k, block in enumerate(blocks):
        if k:
            found.append((k - 1, k, NEXT * proximity(elements, blocks[k - 1].element, block.element)))
        parent = elements[block.element].parent
        if parent in last and last[parent] != k - 1:
            found.append((last[parent], k, SIBLING))
        last[parent] = k
    return found


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labels (True: content) with the least cost: -gain for content or gain for none, below 0 counted as 0, and an edge's
    weight where its ends differ.

    Blocks whose gain outweighs all their edges have their label for sure, and their edges add to the gain
    of the others; this is repeated. Between the blocks left the cut is found by maximum flow.
    """
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, weight in edges:
        near[a][b] = near[a].get(b, 0.0) + weight
        near[b][a] = near[b].get(a, 0.0) + weight
    label: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:
        a = waiting.popleft()
        if label[a] is None and abs(gain[a]) >= sum(near[a].values()):
            label[a] = gain[a] > 0
            for b, weight in near[a].items():
                gain[b] += weight if label[a] else -weight
                del near[b][a]
                waiting.append(b)
            near[a] = {}
    open_nodes = [a for a in range(n) if label[a] is None]
    if open_nodes:
        content = _max_flow(open_nodes, gain, near)
        for a in open_nodes:
            label[a] = a in content
    return label


def _max_flow(nodes: list[int], gain: list[float], near: list[dict[int, float]]) -> set[int]:
    """The nodes on the source's side of the minimum cut: augmenting paths along shortest ways, each found by a search
    from all nodes that the source still feeds. ``near`` holds the capacities and then the rest of them."""
    fed = {a: gain[a] for a in nodes if gain[a] > 0}
    drained = {a: -gain[a] for a in nodes if gain[a] < 0}
    small = 1e-9
    while True:
        came: dict[int, int] = {a: -1 for a, rest in fed.items() if rest > small}
        queue = deque(came)
        end = -1
        while queue:
            a = queue.popleft()
            if drained.get(a, 0.0) > small:
                end = a
                break
            for b, rest in near[a].items():
                if rest > small and b not in came:
                    came[b] = a
                    queue.append(b)
        if end < 0:
            return set(came)
        path = [end]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        start = path[-1]
        amount = min(fed[start], drained[end], *(near[a][b] for b, a in zip(path, path[1:])))
        fed[start] -= amount
        drained[end] -= amount
        for b, a in zip(path, path[1:]):
            near[a][b] -= amount
            near[b][a] += amount


def main_text(page: str | None, weights: np.ndarray) -> str:
    elements, blocks = parse(page)
    if not blocks:
        return ""
    said = pulls(elements)
    scores = np.array([features(elements, b) for b in blocks]) @ weights
    gain = [float(s) + said[b.element] for s, b in zip(scores, blocks)]
    labels = minimum_cut(gain, edges_of(elements, blocks))
    return "\n".join(b.text for b, content in zip(blocks, labels) if content)


# --- over tables --------------------------------------------------------------------------------


def _labelled_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of the blocks whose elements tell the label, in pages that have both kinds."""
    for part in parts(batches, 0):
        rows, labels = [], []
        for page in part.column(0).to_pylist():
            elements, blocks = parse(page)
            said = pulls(elements)
            told = [(b, 1 if said[b.element] > 0 else -1) for b in blocks if abs(said[b.element]) >= MARK_HINT]
            if len({label for _, label in told}) == 2:
                rows += [features(elements, b) for b, _ in told]
                labels += [label for _, label in told]
        listed = pa.array(rows, pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([listed, pa.array(labels, pa.int32())], ["features", "label"])


def fitted(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The weights of a logistic regression that is drawn to ``PRIOR``."""
    weights = PRIOR.copy()
    if not len(rows):
        return weights
    # As much evidence as so many blocks at most, so that the prior holds its own.
    share = min(1.0, 1000 / len(rows))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = share * rows.T @ ((labels > 0) - p) - PRIOR_PRECISION * (weights - PRIOR)
        hessian = share * (rows * (p * (1 - p))[:, None]).T @ rows + PRIOR_PRECISION * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def learn(pages: DataFrame, id: str = "page_id", html: str = "html") -> np.ndarray:
    """The weights of the text features from at most ``SAMPLE_PAGES`` pages, chosen by a hash of the id, and
    ``SAMPLE_BLOCKS`` of their blocks."""
    ids = pages.select(id).filter(F.col(id).isNotNull()).orderBy(F.xxhash64(id), id).limit(SAMPLE_PAGES).distinct()
    ids = written(ids, new_path(pages.sparkSession, "html-ids"))
    sample = pages.join(F.broadcast(ids), id, "left_semi").select(F.col(html).alias("html"))
    found = sample.mapInArrow(_labelled_blocks, "features array<double>, label int")
    found = written(found, new_path(pages.sparkSession, "html-blocks"))
    order = [F.xxhash64("features"), F.col("label")]
    rows = found.orderBy(*order).limit(SAMPLE_BLOCKS).collect()
    return fitted(np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows]))


def extracted(pages: DataFrame, weights: np.ndarray, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The id, the url, ``text`` and ``n_chars`` of each page."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, 2):
            texts = [main_text(page, weights) for page in part.column(2).to_pylist()]
            lengths = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), lengths], [id, url, "text", "n_chars"])

    kinds = {name: pages.schema[name].dataType.simpleString() for name in (id, url)}
    return pages.select(id, url, html).mapInArrow(of_batches, f"`{id}` {kinds[id]}, `{url}` {kinds[url]}, text string, n_chars bigint")
