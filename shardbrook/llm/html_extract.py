"""Main text of web pages by minimum-cut labelling.

A page is read into blocks of text.  A logistic classifier turns what is known of a
block (its elements, names, links, length) into a cost of calling it boilerplate or
content.  Costs become capacities from a source and to a sink, and neighbouring
blocks are tied by edges, stronger the nearer they are in the document tree.  The
minimum cut is the labelling of least total cost.

The classifier's weights for page structure are fixed values; those for the text are
trained: blocks whose structure leaves no doubt, from a bounded sample of the pages
themselves, are its labelled examples.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardbrook.llm.common import map_rows, whole_text

# HTML element kinds, and names that pages give to their parts.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th thead title "
    "tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SKIPPED = frozenset("head iframe math noscript object script style svg template textarea title".split())
RAW = frozenset("script style textarea title".split())
BOILER_TAGS = frozenset(
    "aside button dialog fieldset footer form header menu nav option search select".split()
)
CONTENT_TAGS = frozenset(("article", "main"))
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising alert author-box banner bio breadcrumb "
    "breadcrumbs byline comment comments consent cookie cookies copyright dialog disclaimer "
    "discussion disqus feedback footer footnav form gdpr head header hidden legal login masthead "
    "menu meta modal nav navbar navigation newsletter notice notices notification offer overlay "
    "pager pagination partner paywall popup pro privacy promo promoted promotion related reply "
    "replies respond responses recommended search share sharing side sidebar signin signup skip "
    "social sponsor sponsored sponsors subscribe subscription tags teaser toolbar topbar warning "
    "widget widgets".split()
)
CONTENT_NAMES = frozenset(
    "article body content entry hentry main post prose story text".split()
)
CLOSES = {  # what an opening tag ends if it is still open
    "p": ("p",),
    "li": ("li", "p"),
    "dt": ("dt", "dd", "p"),
    "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
    "option": ("option",),
}
STOPS = frozenset("article aside body div footer form header html main nav ol section table ul".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(
    r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I
)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Weights of what the structure says; positive speaks for content.
STRUCTURE = {
    "content_tag": 3.0,
    "content_name": 1.5,
    "boiler_tag": -6.0,
    "boiler_name": -5.5,
    "hidden": -8.0,
}
# Centre of the weights of what the text says; training moves them.
TEXT = {
    "bias": -0.5,
    "length": 0.8,  # log of one plus words
    "links": -3.0,  # share of characters in links
    "sentence": 0.7,  # ends like a sentence
    "paragraph": 0.5,
    "heading": 0.5,
    "list_item": -0.5,
}
PRIOR = 200.0  # how many examples the centre weighs as much as
SAMPLE_PAGES = 256
TIE, FAR_TIE = 0.5, 0.15  # edges between blocks with one parent, and with others


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # characters in links
    tag: str
    parent: int
    structure: frozenset


@dataclass(slots=True)
class _Open:
    tag: str
    number: int
    structure: frozenset
    skipped: bool
    link: bool


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order; white space inside a block is one space."""
    none = frozenset()
    stack = [_Open("", 0, none, False, False)]
    found: list[Block] = []
    pieces: list[str] = []
    linked = number = at = 0
    home = stack[0]  # the block element that the pieces stand in

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append(Block(text, min(linked, len(text)), home.tag, parent, home.structure))
            pieces.clear()
        linked = 0

    places: dict[str, list[int]] = {}  # depths of open elements by name
    open_blocks: list[int] = []  # depths of open block elements

    def settle() -> None:
        """The block element that text now stands in, and the one around that."""
        nonlocal home, parent
        home = stack[open_blocks[-1] if open_blocks else 0]
        parent = stack[open_blocks[-2] if len(open_blocks) > 1 else 0].number

    def push(entry: _Open) -> None:
        places.setdefault(entry.tag, []).append(len(stack))
        if entry.tag in BLOCK:
            open_blocks.append(len(stack))
        stack.append(entry)

    def close(depth: int) -> None:
        """End the element at ``depth`` and all inside it; each is ended once."""
        inside = open_blocks and open_blocks[-1] >= depth
        if inside:
            flush()
        for entry in stack[depth:]:
            places[entry.tag].pop()
        del stack[depth:]
        while open_blocks and open_blocks[-1] >= depth:
            open_blocks.pop()
        if inside:
            settle()

    def nearest(names) -> int:
        """Depth of the innermost open element of these names; 0 if there is none."""
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    parent = 0
    length = len(page)
    while at < length:
        tag = TAG.search(page, at)
        upto = tag.start() if tag else length
        top = stack[-1]
        if upto > at and not top.skipped:
            text = html.unescape(page[at:upto])
            pieces.append(text)
            if top.link:
                linked += len(text)
        if not tag:
            break
        at = tag.end()
        name = tag["name"] or tag["name2"]
        if not name:
            continue
        name = name.lower()
        if tag["end"] or tag["end2"]:
            depth = nearest((name,))
            if depth:
                close(depth)
            continue
        if name == "br":
            pieces.append("\n")
            continue
        if name in VOID:
            if name in BLOCK:
                flush()
            continue
        rest = tag["rest"] if tag["name"] else tag["rest2"]
        # An open paragraph ends where a block begins; other elements as listed.
        ends = CLOSES.get(name, ("p",) if name in BLOCK else ())
        depth = nearest(ends)
        while depth and depth >= nearest(STOPS):
            close(depth)
            depth = nearest(ends) if name == "tr" else 0
        top = stack[-1]
        structure = _structure(name, rest, top.structure)
        number += 1
        entry = _Open(
            name, number, structure, top.skipped or name in SKIPPED, top.link or name == "a"
        )
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else length
            continue
        if rest.endswith("/") and name not in BLOCK:
            continue
        if name in BLOCK:
            flush()
            push(entry)
            settle()
        else:
            push(entry)
    flush()
    return found


def _structure(name: str, rest: str, above: frozenset) -> frozenset:
    own = set()
    if name in BOILER_TAGS:
        own.add("boiler_tag")
    elif name in CONTENT_TAGS:
        own.add("content_tag")
    if rest and name not in ("html", "body"):
        named = NAMES.findall(rest)
        if named:
            words = set()
            for value in named:
                words.update(w.lower() for w in WORD.findall("".join(value)))
            if words & BOILER_NAMES and name not in CONTENT_TAGS:
                own.add("boiler_name")
            elif words & CONTENT_NAMES:
                own.add("content_name")
        if HIDDEN.search(rest):
            own.add("hidden")
    return above | own if own else above


def text_features(block: Block) -> list[float]:
    """In the order of ``TEXT``."""
    words = block.text.count(" ") + 1
    return [
        1.0,
        math.log1p(words),
        block.linked / len(block.text),
        1.0 if block.text[-1] in ".!?…:;\"'”’»" else 0.0,
        1.0 if block.tag in ("p", "blockquote", "pre", "dd") else 0.0,
        1.0 if block.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else 0.0,
        1.0 if block.tag in ("li", "td", "th", "dt") else 0.0,
    ]


def examples_of(page: str) -> Iterator[tuple[list[float], float]]:
    """Text features and a mark for blocks whose structure leaves no doubt."""
    for block in blocks_of(page):
        s = block.structure
        poor = "boiler_tag" in s or "boiler_name" in s or "hidden" in s
        if poor or "content_tag" in s:
            yield text_features(block), 0.0 if poor else 1.0


def train_text_weights(
    examples: list[tuple[list[float], float]], prior: float = PRIOR
) -> list[float]:
    """Weights of text features from ``examples_of`` pages.

    Logistic regression by Newton steps; a Gaussian prior holds the weights near their
    centre, and good and poor examples count as much in total.
    """
    centre = np.array(list(TEXT.values()))
    rows, marks = [f for f, _ in examples], [m for _, m in examples]
    if not rows or min(marks) == max(marks):
        return centre.tolist()
    x, y = np.array(rows), np.array(marks)
    weigh = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = centre.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weigh * (y - p)) - prior * (w - centre)
        bend = (x * (weigh * p * (1 - p))[:, None]).T @ x + prior * np.eye(len(w))
        w += np.linalg.solve(bend, slope)
    return w.tolist()


def cost_of(block: Block, weights: list[float]) -> float:
    """Log odds of content."""
    text = sum(w * f for w, f in zip(weights, text_features(block)))
    return text + sum(STRUCTURE[s] for s in block.structure)


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges: each block to the next, and to the next one with the same parent."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        before = last.get(block.parent)
        if before is not None:
            edges.append((before, i, TIE / (1 if i - before == 1 else 2)))
        if i and before != i - 1:
            edges.append((i - 1, i, FAR_TIE))
        last[block.parent] = i
    return edges


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling (True: content) of least cost; costs and ties are capacities.

    A block whose own cost outweighs all its open ties takes its own side in every
    minimum cut.  Such blocks are settled first and pass their ties on to the
    neighbours as costs; maximum flow decides the others.
    """
    own = list(costs)
    around: list[dict[int, float]] = [{} for _ in own]
    for i, j, w in edges:
        around[i][j] = around[i].get(j, 0.0) + w
        around[j][i] = around[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * len(own)
    waiting = deque(range(len(own)))
    while waiting:
        i = waiting.popleft()
        if label[i] is not None or abs(own[i]) <= sum(around[i].values()):
            continue
        label[i] = own[i] > 0
        for j, w in around[i].items():
            own[j] += w if label[i] else -w
            del around[j][i]
            waiting.append(j)
        around[i].clear()
    open_ = [i for i, side in enumerate(label) if side is None]
    if open_:
        content = _source_side(open_, own, around)
        for i in open_:
            label[i] = i in content
    return [bool(side) for side in label]


def _source_side(nodes: list[int], own: list[float], around: list[dict[int, float]]) -> set[int]:
    """Maximum flow by blocking flows on level graphs; what the source still reaches."""
    source, sink = -1, -2
    left: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in nodes:
        left[i] = dict(around[i])
    for i in nodes:
        if own[i] > 0:
            left[source][i] = own[i]
            left[i][source] = 0.0
        elif own[i] < 0:
            left[i][sink] = -own[i]
            left[sink][i] = 0.0
    tiny = 1e-12
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for b, c in left[a].items():
                if c > tiny and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return {i for i in nodes if i in level}
        ahead = {a: iter(list(left[a])) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                flow = min(left[u][v] for u, v in zip(path, path[1:]))
                cut = 0
                for k, (u, v) in enumerate(zip(path, path[1:])):
                    left[u][v] -= flow
                    left[v][u] = left[v].get(u, 0.0) + flow
                    if left[u][v] <= tiny and not cut:
                        cut = k + 1
                # Go on from the first edge that is full; it is looked at again there.
                del path[cut:]
                continue
            for b in ahead[a]:
                if left[a][b] > tiny and level.get(b, -1) == level[a] + 1:
                    path.append(b)
                    break
            else:
                path.pop()


def extract_page(page: str, weights: list[float]) -> str:
    blocks = blocks_of(page)
    labels = minimum_cut([cost_of(b, weights) for b in blocks], ties(blocks))
    return "\n\n".join(b.text for b, content in zip(blocks, labels) if content)


def learn(
    pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES
) -> list[float]:
    """Text weights from at most ``sample`` pages: those with the smallest id hashes.

    Pages are first thinned out to about twice as many, so that what is sorted does not grow
    with the number of tasks.  Examples are drawn from them on the executors; the
    driver gets a few numbers for each block and no page.
    """
    share = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1_000_000_000)) / 1e9
    chosen = (
        pages.select(F.col(id_col).alias("_id"), whole_text(html_col).alias("_html"))
        .where(share < 2 * sample / max(1, pages.count()))
        .orderBy(F.xxhash64("_id"), "_id", F.xxhash64("_html"))
        .limit(sample)
        .select("_html")
    )

    def setup():
        def apply(columns):
            for (page,) in zip(*columns):
                for features, mark in examples_of(page):
                    yield (features, mark), 128

        return apply

    schema = T.StructType(
        [
            T.StructField("features", T.ArrayType(T.DoubleType())),
            T.StructField("mark", T.DoubleType()),
        ]
    )
    return train_text_weights([tuple(r) for r in map_rows(chosen, setup, schema).collect()])


def extract(
    pages: DataFrame,
    weights: list[float],
    *,
    id_col: str = "page_id",
    html_col: str = "html",
    keep: tuple[str, ...] = ("url",),
) -> DataFrame:
    """``id_col, keep..., text, n_chars`` for every row: the main text of the page.

    Blocks of content are joined by an empty line, in page order.  A null or empty
    page, or one without content, has an empty text.  Unclosed and broken markup is
    read to the end.  Null and repeated ids are taken like any other row; columns not
    named are not read.  No shuffle; a page is read by the task that scans it.
    """
    rows = pages.select(F.col(id_col), *keep, whole_text(html_col).alias("_html"))

    def setup():
        def apply(columns):
            for *own, page in zip(*columns):
                text = extract_page(page, weights)
                yield (*own, text), len(text) * 2 + 64

        return apply

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())])
    return map_rows(rows, setup, schema).withColumn("n_chars", F.length("text").cast("long"))
