"""HTML extraction (operator 6): blocks labelled content or boilerplate by a minimum cut.

A page is read into blocks: the text between two block-level tags, with its place in the document tree. Missing end tags, stray
ones, comments, scripts and styles are dealt with in `blocks`. Each block gets a score for content: what its ancestors say (tags,
roles, class names; the nearest counts most) and a logistic regression on length, links, punctuation and tags, which is fitted on
a bounded sample of pages (PAGES) whose ancestors leave no doubt. A positive score is the capacity from the source, a negative one
that to the sink. Smoothness edges join neighbours in page order and consecutive blocks of one container, the stronger the nearer
they are in the tree. The minimum cut, found by maximum flow, separates content from boilerplate; nothing else is cut or capped.

Null or empty html gives empty text; text is the content blocks in page order, white space in a block as one space, joined by two
line feeds. Rows may repeat; each gets its result.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.text import chunks
from waybill.llm.toxicity import fitted

#: Tags by their part in a page.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset("script style noscript template title svg math canvas iframe object audio video head textarea button select option datalist".split())
RAW_TAGS = frozenset("script style title textarea iframe noscript".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset(["article", "main"])
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner promo promotion sponsor sponsored nav navbar navigation menu submenu sidebar "
    "side rail footer header masthead topbar toolbar comment comments commentlist commentary reply replies respond discussion disqus cookie cookies "
    "consent gdpr notice notices alert alerts popup modal overlay dialog share sharing social follow related recommended recommendations trending popular "
    "subscribe subscription newsletter signup signin login register search breadcrumb breadcrumbs pagination pager paging widget widgets copyright legal "
    "skip tags taxonomy byline form feedback rating contact".split()
)
CONTENT_NAMES = frozenset("article content main post entry story text body articlebody maincontent".split())
ROLES = {"navigation": -8.0, "banner": -8.0, "contentinfo": -8.0, "complementary": -8.0, "search": -8.0, "form": -8.0, "dialog": -8.0, "alert": -8.0, "menu": -8.0, "main": 6.0, "article": 6.0}

PAGES = 2_000
FADE = 0.6  # what each further ancestor with a signal counts
BESIDE, WITHIN = 0.8, 0.6  # capacities of edges in page order, and in a container
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str
    links: int  # characters in links
    tag: str
    container: int  # the element that holds it
    path: tuple[int, ...]
    signal: float


def signal_of(tag: str, attributes: str, inside: bool) -> float:
    """What an element says of its content: above 0 for content. `inside`: an article or main element is around it."""
    told = 6.0 if tag in CONTENT_TAGS else -8.0 if tag in BOILER_TAGS else (-1.5 if inside else -8.0) if tag == "header" else 0.0
    if "=" in attributes or "hidden" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value) or name == "aria-hidden" and value == "true":
                told = -20.0
            elif name == "role":
                told = min(told, ROLES.get(value.lower(), 0.0)) or ROLES.get(value.lower(), 0.0)
            elif name in ("class", "id"):
                own = {x.lower() for x in NAME.findall(value)}
                if own & BOILER_NAMES and tag not in ("body", "html"):
                    told = min(told, -8.0)
                elif own & CONTENT_NAMES:
                    told = max(told, 2.0) if told >= 0 else told
    return told


def blocks(page: str) -> list[Block]:
    """The blocks of a page in its order."""
    found: list[Block] = []
    stack: list[tuple[str, int, float, bool]] = [("", 0, 0.0, False)]  # tag, number, signal, block-level
    parts: list[str] = []
    links = made = dropped = linked = inside = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                signals = [s for _, _, s, _ in reversed(stack) if s]
                held = [(t, n) for t, n, _, b in stack if b]
                found.append(Block(text, min(links, len(text)), held[-1][0] if held else "", held[-2][1] if len(held) > 1 else 0, tuple(n for _, n in held), sum(s * FADE**k for k, s in enumerate(signals))))
            parts.clear()
        links = 0

    def close(depth: int) -> None:
        nonlocal dropped, linked, inside
        if any(b for *_, b in stack[depth:]):
            flush()
        for tag, *_ in stack[depth:]:
            dropped -= tag in DROPPED_TAGS
            linked -= tag == "a"
            inside -= tag in CONTENT_TAGS
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        match = TOKEN.search(page, at)
        text = page[at : match.start() if match else end]
        if text and not dropped:
            parts.append(text)
            links += len(text) if linked else 0
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            # An inline end tag reaches no further than its block.
            if depth and (tag in BLOCK_TAGS or not any(b for *_, b in stack[depth + 1 :])):
                close(depth)
            elif tag in BLOCK_TAGS:
                flush()
            continue
        if tag in BLOCK_TAGS:
            if stack[-1][0] != "" and tag != "body":
                implied = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(tag, ())
                bar = {"li": ("ul", "ol", "menu"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}.get(tag, ("dl", "select"))
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p" or stack[i][0] in implied or (stack[i][0] == "head" and tag != "head"):
                        close(i)
                        if tag != "tr":
                            break
                    elif i < len(stack) and stack[i][3] and stack[i][0] in (*bar, *CONTENT_TAGS, *BOILER_TAGS, "div", "section", "body"):
                        break
            if tag == "body":
                head = next((i for i in range(1, len(stack)) if stack[i][0] == "head"), 0)
                if head:
                    close(head)
            flush()
        elif tag == "br":
            parts.append(" ")
        if tag in VOID_TAGS or match[3].endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag in RAW_TAGS:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        made += 1
        stack.append((tag, made, signal_of(tag, match[3], inside > 0), tag in BLOCK_TAGS))
        dropped += tag in DROPPED_TAGS
        linked += tag == "a"
        inside += tag in CONTENT_TAGS
    close(1)
    flush()
    return found


def traits(block: Block) -> list[float]:
    n = len(block.text)
    return [1.0, min(np.log1p(n) / 5, 2.0), block.links / n, min(10 * sum(map(block.text.count, ".,;:!?")) / n, 1.0), float(block.tag == "p"), float(block.tag in ("li", "td", "th", "dd", "dt")), float(block.tag[:1] == "h" and block.tag[1:].isdigit())]


#: Used where no page of the sample has blocks of both kinds.
PLAIN = np.array([-1.5, 2.5, -4.0, 1.0, 1.0, -0.5, 0.5])


def tree_distance(a: Block, b: Block) -> int:
    same = next((i for i, (x, y) in enumerate(zip(a.path, b.path, strict=False)) if x != y), min(len(a.path), len(b.path)))
    return len(a.path) + len(b.path) - 2 * same


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the source's side: scores are terminal capacities, edges join nodes both ways. By Dinic's maximum flow."""
    n = len(scores)
    source, sink = n, n + 1
    to: list[int] = []
    left: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        left.extend((there, back))

    for i, s in enumerate(scores):
        if s > 0:
            add(source, i, s, 0.0)
        elif s < 0:
            add(i, sink, -s, 0.0)
    for a, b, c in edges:
        add(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source], todo = 0, deque([source])
        while todo:
            a = todo.popleft()
            for e in out[a]:
                if left[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    todo.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        following = [0] * (n + 2)
        path: list[int] = []
        while True:
            a = to[path[-1]] if path else source
            if a == sink:
                flow = min(left[e] for e in path)
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow
                path = path[: next(i for i, e in enumerate(path) if left[e] <= 1e-9)]
                continue
            while following[a] < len(out[a]):
                e = out[a][following[a]]
                if left[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    path.append(e)
                    break
                following[a] += 1
            else:
                if not path:
                    break
                following[to[path.pop() ^ 1]] += 1


def content(page: str, weights: np.ndarray) -> list[str]:
    """The content blocks of a page."""
    own = blocks(page)
    if not own:
        return []
    logits = np.clip(np.array([traits(b) for b in own]) @ weights, -2.0, 2.0)
    scores = [b.signal + float(x) for b, x in zip(own, logits, strict=True)]
    edges, last = [], {}
    for i, b in enumerate(own):
        if i:
            edges.append((i - 1, i, BESIDE / (1 + max(0, tree_distance(own[i - 1], b) - 2))))
        if b.container in last and last[b.container] < i - 1:
            edges.append((last[b.container], i, WITHIN))
        last[b.container] = i
    if all(s > 0 for s in scores):
        return [b.text for b in own]
    return [b.text for b, kept in zip(own, minimum_cut(scores, edges), strict=True) if kept]


def learn(pages: DataFrame, sample: int = PAGES) -> np.ndarray:
    """Weights of the traits, from at most `sample` pages (the smallest hashes of page_id) whose blocks' ancestors are clear."""
    chosen = pages.where("html is not null and page_id is not null").select("page_id", F.col("html").cast("string").alias("html"), F.xxhash64("page_id").alias("h"))
    ids = chosen.select("h", "page_id").orderBy("h", "page_id").limit(sample)
    rows = chosen.join(F.broadcast(ids), ["h", "page_id"]).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the traits' second moments would not do for a logistic fit: each block sends its few numbers."""
        for batch in chunks(batches, "html"):
            own = [b for p in batch.column("html").to_pylist() for b in blocks(p) if abs(b.signal) >= 4]
            yield pa.record_batch([pa.array([traits(b) for b in own], pa.list_(pa.float64())), pa.array([int(b.signal > 0) for b in own], pa.int32())], names=["x", "y"])

    moments = rows.mapInArrow(run, "x array<double>, y int").groupBy(F.transform("x", lambda v: F.round(v, 2)).alias("x"), "y").count()
    got = moments.orderBy(F.xxhash64("x"), "y").limit(20 * sample).collect()
    if len({r.y for r in got}) < 2:
        return PLAIN
    times = np.array([min(r["count"], 50) for r in got])
    return fitted(np.repeat(np.array([r.x for r in got]), times, axis=0), np.repeat(np.array([r.y for r in got], float), times))


def extracted(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per row: page_id, url, text and n_chars."""
    source = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = ["\n\n".join(content(p, weights)) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
