"""Main text of web pages by minimum-cut labelling.

A page is read into blocks: runs of text between block-level tags, with the tags and names they stand in. A logistic classifier gives each block a
cost of being content and a cost of being boilerplate; these are the capacities of its edges to the two terminals. Blocks that follow each other
and blocks of the same parent are joined by smoothness edges, weaker the further apart they are in the tree. The maximum flow separates
content from boilerplate at the least total cost.

The classifier starts from stated weights and is fitted to blocks of at most ``sample`` pages (the documented bound of the fit) that mark their article themselves
with ``article`` or ``main``; without such pages the stated weights hold.

Defined cases: NULL or empty html gives an empty text; unclosed and misnested tags close where a browser would close them (a paragraph at the next block,
an item at the next item); what stands in ``noscript``, ``template``, ``object`` and the like is no text of the page; a page of text without tags is one block and judged like any other; repeated rows give repeated results; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import with_outputs

# Names of elements.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
 frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
 title head option""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED_TAGS = frozenset("""script style noscript template iframe object svg math canvas audio video select textarea button head datalist
 applet map""".split())
FORM_TAGS = frozenset("form fieldset label input legend".split())
# Words that name parts of a page in class, id, role and element names.
GOOD = frozenset("article main content contents post entry story body blog text".split())
BAD = frozenset("""nav navbar navigation menu menus footer contentinfo aside complementary sidebar sidebars ad ads advert adverts advertisement advertising promo
 promos promoted promotion promotions banner banners sponsor sponsored sponsors cookie cookies consent popup modal comment comments commenting replies reply discussion
 discussions related recommend recommended recommendation recommendations newsletter breadcrumb breadcrumbs pagination pager toolbar widget widgets masthead copyright
 skip""".split())
# These name a topic or a tool as often as a part, so an element that calls itself an article outweighs them.
WEAK = frozenset("alert disclaimer form legal login notice notices search share sharing side signup social subscribe tag tags toc".split())
# A name of several words that starts with one of these tells about the page or its topic, not which part this is.
ABOUT = frozenset("category cat tag topic term section type status format author label language lang has is no with without theme template page single".split())
_TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>(?:[^>"']|"[^"]*"|'[^']*')*))>|(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""",
                  re.DOTALL)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


def named_part(tag: str, names: list[str], in_article: bool) -> int:
    """1 for an element that calls itself the article, -1 for a menu, notice, form and so on, 0 for neither.

    Each of its names counts: the last word of a name says what it is, the others of which kind. ``article`` and ``main`` count for two good names, and names
    of doubtful meaning (``WEAK``) decide only where no better ones stand against them.
    """
    good = 2 if tag in ("article", "main") else 0
    bad = 3 if tag in FORM_TAGS or tag in BAD or tag == "header" and not in_article else 0
    doubtful = False
    for name in names:
        words = [word.lower() for word in _SPLIT.split(name) if word]
        if not words or len(words) > 1 and words[0] in ABOUT:
            continue
        if any(word in BAD for word in words):
            bad += 3
        elif words[-1] in GOOD or len(words) == 2 and words[0] in GOOD and words[1] not in WEAK:
            good += 2
        elif any(word in WEAK for word in words):
            doubtful = True
    return -1 if bad > good or doubtful and not good else 1 if good else 0


@dataclass
class Block:
    """A run of text and where it stands."""

    tag: str
    element: int
    tree: list[tuple[int, int]]      # parent and depth of each element of the page
    good: int                # depth of the nearest element named like an article, 0 for none
    bad: int                 # depth of the nearest element named like a menu, notice, form and so on, 0 for none
    article: bool            # inside article or main
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.pieces)).split())


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in its order, without those that hold no text."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, int, bool]] = [("", 0, 0, 0, False)]       # tag, number, good, bad, article
    tree = [(0, 0)]
    open_tags: dict[str, int] = {}
    links, at, n = 0, 0, len(page)
    current: Block | None = None

    def add(text: str) -> None:
        nonlocal current
        if current is None:
            if text.isspace():
                return
            tag, number, good, bad, article = stack[-1]
            current = Block(tag, number, tree, good, bad, article)
            out.append(current)
        current.pieces.append(text)
        if links:
            current.linked += len(text)

    while at < n:
        found = _TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at:found.start()])
        at = found.end()
        name = found.group(2) or found.group(5)
        if name is None:
            continue
        name = name.lower()
        closing = bool(found.group(1) or found.group(4))
        if name == "br" and current is not None:
            current.pieces.append(" ")
        if name == "a":
            links = 0 if closing else 1
        if name in SKIPPED_TAGS and not closing:
            attributes = found.group(3) or found.group(6) or ""
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                body = page.find("<body", at) if name == "head" and end is None else -1
                at = end.end() if end else body if body >= 0 else n
            continue
        if name not in BLOCK_TAGS and name not in FORM_TAGS:
            continue
        current, links = None, 0
        if closing:
            for depth in range(len(stack) - 1, 0, -1) if open_tags.get(name) else ():
                if stack[depth][0] == name:
                    for tag, *_ in stack[depth:]:
                        open_tags[tag] -= 1
                    del stack[depth:]
                    break
            continue
        if name in VOID_TAGS:
            continue
        if stack[-1][0] == "p" or stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            open_tags[stack.pop()[0]] -= 1
        _, parent, good, bad, article = stack[-1]
        depth = len(stack)
        part = named_part(name, [x for values in _NAMES.findall(found.group(3) or found.group(6) or "") for value in values for x in value.split()], article)
        if part < 0:
            bad = depth
        elif part:
            good = depth
        open_tags[name] = open_tags.get(name, 0) + 1
        stack.append((name, len(tree), good, bad, article or name in ("article", "main") and part > 0))
        tree.append((parent, depth))
    return [block for block in out if block.text()]


FEATURES = ("constant", "in a named part", "nearest name is good", "nearest name is bad", "no name", "log length", "share of links", "ends a sentence",
            "paragraph", "heading", "item or cell", "short", "place")
# Stated weights that the fit starts from.
PRIOR = np.array([-0.5, 0.5, 2.5, -4.5, 0.8, 0.5, -3.0, 0.5, 0.8, 0.3, -0.5, -0.6, 0.0])


def features(blocks: list[Block], texts: list[str]) -> np.ndarray:
    """One row for each block."""
    rows = []
    for i, (b, text) in enumerate(zip(blocks, texts, strict=True)):
        size = len(text)
        rows.append((1, b.good > 0 or b.bad > 0, b.good > b.bad, b.bad > b.good or b.bad > 0 and not b.good, b.good == b.bad == 0, np.log1p(size) / 5,
                     min(1.0, b.linked / size), text[-1] in ".!?:;。！？", b.tag in ("p", "pre", "blockquote"), b.tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
                     b.tag in ("li", "td", "th", "option", "dd", "dt"), size < 25, i / len(blocks)))
    return np.array(rows, dtype=np.float64)


def fit(pages: list[str], rounds: int = 200, hold: float = 5.0) -> np.ndarray:
    """Logistic weights, held near ``PRIOR``, from pages that mark their article."""
    data, labels = [], []
    for page in pages:
        blocks = blocks_of(page)
        if any(b.article for b in blocks):
            data.append(features(blocks, [b.text() for b in blocks]))
            labels += [b.article and b.bad <= b.good for b in blocks]
    weights = PRIOR.copy()
    if not data:
        return weights
    x, y = np.vstack(data), np.array(labels, dtype=np.float64)
    square = np.full_like(weights, 1e-6)
    for _ in range(rounds):
        grad = x.T @ (1 / (1 + np.exp(-x @ weights)) - y) + hold * (weights - PRIOR)
        square += grad * grad
        weights -= 0.2 * grad / np.sqrt(square)
    return weights


def least_cut(content: np.ndarray, boilerplate: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Which nodes lie on the content side of a minimum cut.

    ``content[i]`` is cut off if node i becomes boilerplate and ``boilerplate[i]`` if it becomes content; an edge costs its weight when
    its ends differ. Flow is pushed along shortest paths, level by level.
    """
    n = len(content)
    net = content - boilerplate                      # what is left after the flow straight through each node
    supply, demand = np.maximum(net, 0).tolist(), np.maximum(-net, 0).tolist()
    room: dict[tuple[int, int], float] = {}
    near: list[list[int]] = [[] for _ in range(n)]
    for a, b, weight in edges:
        if (a, b) not in room:
            near[a].append(b)
            near[b].append(a)
        room[a, b] = room.get((a, b), 0.0) + weight
        room[b, a] = room.get((b, a), 0.0) + weight
    tiny = 1e-9
    while True:
        level = {i: 0 for i in range(n) if supply[i] > tiny}
        queue, reached = deque(level), False
        while queue:
            a = queue.popleft()
            reached = reached or demand[a] > tiny
            for b in near[a]:
                if b not in level and room[a, b] > tiny:
                    level[b] = level[a] + 1
                    queue.append(b)
        if not reached:
            side = np.zeros(n, bool)
            side[list(level)] = True
            return side
        turn = [0] * n
        for start in [i for i in level if level[i] == 0]:
            trail = [start]
            while trail and supply[start] > tiny:
                a = trail[-1]
                if demand[a] > tiny:
                    push = min([supply[start], demand[a], *[room[p, q] for p, q in zip(trail, trail[1:], strict=False)]])
                    supply[start] -= push
                    demand[a] -= push
                    for p, q in zip(trail, trail[1:], strict=False):
                        room[p, q] -= push
                        room[q, p] += push
                    trail = [start]
                    continue
                while turn[a] < len(near[a]):
                    b = near[a][turn[a]]
                    if level.get(b) == level[a] + 1 and room[a, b] > tiny:
                        trail.append(b)
                        break
                    turn[a] += 1
                else:
                    trail.pop()
                    if trail:
                        turn[trail[-1]] += 1


def smoothness(blocks: list[Block], follow: float, kin: float) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other, weaker with their distance in the tree, and between neighbours of one parent."""
    out = []
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        tree = block.tree
        if i:
            x, y, apart = blocks[i - 1].element, block.element, 0
            while x != y:
                if tree[x][1] >= tree[y][1]:
                    x = tree[x][0]
                else:
                    y = tree[y][0]
                apart += 1
            out.append((i - 1, i, follow / (1 + apart)))
        above = tree[block.element][0]
        if above in last:
            out.append((last[above], i, kin))
        last[above] = i
    return out


def main_text(page: str | None, weights: np.ndarray, follow: float = 0.5, kin: float = 0.5) -> str:
    """The content blocks of a page, one a line."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    texts = [block.text() for block in blocks]
    odds = features(blocks, texts) @ weights
    # costs of a wrong label: minus the logarithm of its probability
    content, boilerplate = np.logaddexp(0, odds), np.logaddexp(0, -odds)
    side = least_cut(content, boilerplate, smoothness(blocks, follow, kin))
    return "\n".join(text for text, kept in zip(texts, side, strict=True) if kept)


def learn(pages: DataFrame, html: str = "html", sample: int = 300) -> np.ndarray:
    """Weights from at most ``sample`` pages, taken by the hash of their html."""
    keyed = pages.select(F.coalesce(F.col(html), F.lit("")).alias("page")).withColumn("key", F.xxhash64("page"))
    picked = keyed.select("key").distinct().orderBy("key").limit(sample)
    rows = keyed.join(F.broadcast(picked), "key").dropDuplicates(["key"]).orderBy("key").collect()      # at most `sample` pages
    return fit([row["page"] for row in rows])


def extract(pages: DataFrame, html: str = "html", out: str = "text", weights: np.ndarray | None = None, sample: int = 300) -> DataFrame:
    """``pages`` without the html, with its main text in ``out``."""
    fitted = learn(pages, html, sample) if weights is None else weights
    return with_outputs(pages, html, f"`{out}` string", lambda values: [[main_text(page, fitted) for page in values]], drop=[html])
