"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the root-to-leaf path of block
elements around it (tag names with their class words; ids of containers too).
Inline elements do not lengthen a path, so no sentence is cut at its bold word.
Per path: characters of text, punctuation marks, characters inside links and
number of blocks. Both ratios (text per block and punctuation per block) are
smoothed over the page's order within a container (``div``, ``article`` and the
like), fused by their geometric mean, damped by the share of link text, and
weighted by what the path says of itself: more inside ``article`` or ``main``,
little inside headers, forms and elements that name themselves adverts, menus
and the like, nothing inside ``nav``, ``aside``, ``footer`` and what a browser
does not show. Paths at or above the page's threshold are content. What lies
with them in their containers, and in the containers around those up to the
``article`` or the common element, is part of the same text (headings, short
items, linked paragraphs) unless it weighs less or is a list of links.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.workers import ready

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var ruby rb rt rp wbr img br".split())
UNSEEN = frozenset("head title script style noscript template button select option textarea input iframe object svg "
                   "math canvas audio video picture datalist map frameset noframes".split())
APART = frozenset("nav aside footer menu dialog".split())
DOUBTFUL = frozenset("header form fieldset".split())
CONTAINERS = frozenset("html body div article main form fieldset".split()) | APART
HEAD_ONLY = frozenset("title style script meta link base noscript template head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu "
                       "menubar toolbar status tablist".split())
SIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                       "cookie cookies consent gdpr notice notices alert alerts sidebar side rail menu menus nav navbar "
                       "navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist reply "
                       "replies respond discussion disqus related recommended share sharing social newsletter subscribe "
                       "subscription popup modal overlay login signin signup widget widgets pagination pager toolbar "
                       "skip hidden copyright tags byline-links paywall search".split())
APART_WORDS = frozenset("comment comments commentlist reply replies respond discussion disqus related recommended".split())
MAIN_WORDS = frozenset("content main article post entry story body".split())
CLOSED_BY_BLOCK = frozenset({"p"})
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
PUNCTUATION = re.compile(r"[.,;:!?。,、;:!?…]")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|xmp|noembed|noframes)\b[^>]*>.*?(?:</\1\s*[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
                       re.I)
WORDS = re.compile(r"[a-z0-9]+")
# "no-sidebar", "page-with-header": says what is or is not beside the element
BESIDE = re.compile(r"(?<![a-z0-9])(?:no|not|without|with|has|have)[-_]\S*")

#: Weights of a path's score, and the share of the page's mean score that content reaches.
CONTENT, PLAIN, SIDE, THRESHOLD = 2.0, 1.0, 0.03, 0.5


class Element(NamedTuple):
    """An open element. Text in it has ``path`` and ``weight``; ``container`` is
    the path of the container around it; ``apart``: among comments, menus or the
    like; ``unseen``: not shown by a browser."""
    tag: str
    path: str
    weight: float
    container: str
    apart: bool
    unseen: bool


class Block(NamedTuple):
    path: str
    tag: str
    weight: float
    container: str
    texts: list[tuple[str, bool]]  # text, in a link


def _side_words(value: str) -> set[str]:
    """Words of a class or id that name side matter."""
    tokens = [set(WORDS.findall(t)) for t in BESIDE.sub(" ", value).split()]
    if any(t and t <= MAIN_WORDS for t in tokens):
        return set()
    return set().union(*tokens) & SIDE_WORDS


def _open(tag: str, attributes: str, outer: Element, containers: dict[str, tuple[str, bool]]) -> Element:
    """The element that a start tag opens inside ``outer``."""
    inline = tag in INLINE
    classes = names = ""
    unseen, apart = outer.unseen or tag in UNSEEN, outer.apart or tag in APART
    content, nothing, doubt = tag in ("article", "main"), tag in APART, False
    if tag in DOUBTFUL:
        doubt = not (tag == "header" and outer.weight >= CONTENT)
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "class" or (key == "id" and (tag in CONTAINERS or tag == "section")):
            if inline:
                continue
            words = _side_words(value)
            if tag in ("article", "main"):
                words &= APART_WORDS
            if words and tag not in ("html", "body"):
                doubt = True
                apart = apart or bool(words & APART_WORDS)
            if key == "class":
                classes += "." + value
            elif tag in CONTAINERS:
                names += "#" + value
        elif key == "role":
            nothing, apart = nothing or value in SIDE_ROLES, apart or value in SIDE_ROLES
            doubt = doubt or value == "form"
            content = content or value in ("main", "article")
        elif key == "itemprop":
            content = content or value == "articlebody"
        elif tag not in ("html", "body") and (key == "hidden" or (key == "aria-hidden" and value == "true") or (
                key == "style" and "display:none" in value.replace(" ", ""))):
            unseen = True
    if inline:
        return outer._replace(tag=tag, unseen=unseen)
    weight = outer.weight
    if tag == "main":
        weight, apart = CONTENT, False
    elif content:
        weight = SIDE if apart else CONTENT
    weight *= (0.0 if nothing else 1.0) * (SIDE if doubt else 1.0)
    path = f"{outer.path}/{tag}{classes}{names}"
    if tag in CONTAINERS or content or (tag == "section" and classes):
        containers.setdefault(path, (outer.container, content))
        return Element(tag, path, weight, path, apart, unseen)
    return Element(tag, path, weight, outer.container, apart, unseen)


def text_blocks(page: str) -> tuple[list[Block], dict[str, tuple[str, bool]]]:
    """The blocks with text in page order, and per container the one around it
    and whether it declares itself content."""
    containers: dict[str, tuple[str, bool]] = {}
    blocks: dict[int, Block] = {}
    stack = [Element("", "", PLAIN, "", False, False)]
    block, at, links = 0, 0, 0

    def text(value: str, linked: bool) -> None:
        e = stack[-1]
        if e.unseen:
            return
        if block not in blocks:
            tag = next((x.tag for x in reversed(stack) if x.tag not in INLINE), "")
            blocks[block] = Block(e.path, tag, e.weight, e.container, [])
        blocks[block].texts.append((html.unescape(value), linked))

    def raw(value: str) -> None:
        if stack[-1].tag == "head" and value.strip():  # text ends the head
            stack.pop()
        text(value, links > 0)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            raw(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1] and m[1].lower() not in ("script", "style"):
                block += 1
            continue
        tag = tag.lower()
        if not m[2] and tag not in HEAD_ONLY and (stack[-1].tag == "head" or tag == "body"):
            i = next((i for i, x in enumerate(stack) if x.tag == "head"), len(stack))
            del stack[i:]
        if tag == "br":
            text(" ", False)
            continue
        is_block = tag not in INLINE
        block += is_block
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    links -= sum(x.tag == "a" for x in stack[i:])
                    del stack[i:]
                    break
                if not is_block and stack[i].tag not in INLINE:
                    break
                if stack[i].tag in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
                    break
            continue
        if tag in VOID:
            continue
        if is_block:
            shut = SIBLINGS.get(tag, CLOSED_BY_BLOCK)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in shut:
                    links -= sum(x.tag == "a" for x in stack[i:])
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE and stack[i].tag not in ("p", "dt", "dd", "td", "th", "tr"):
                    break
        if m[4].endswith("/>") and tag not in ("a", "p", "div", "span") and is_block:
            continue
        links += tag == "a"
        stack.append(_open(tag, m[4], stack[-1], containers))
    if at < len(page):
        raw(page[at:])
    return [b for b in blocks.values() if any(t.strip() for t, _ in b.texts)], containers


def _smooth(values: np.ndarray) -> np.ndarray:
    kernel = np.array([0.25, 0.5, 0.25])
    return np.convolve(np.pad(values, 1, mode="edge"), kernel, mode="valid")


class Path(NamedTuple):
    score: float
    links: float  # share of the characters
    chars: int
    weight: float
    container: str


def path_scores(blocks: list[Block]) -> dict[tuple[str, float], Path]:
    """Smoothed, fused and weighted score of each tag path with text, by (path, weight)."""
    sums: dict[tuple[str, float], list[int]] = {}
    runs: dict[str, list[tuple[str, float]]] = {}
    for b in blocks:
        key = (b.path, b.weight)
        if key not in sums:
            sums[key] = [0, 0, 0, 0]
            runs.setdefault(b.container, []).append(key)
        r = sums[key]
        for t, linked in b.texts:
            n = len(t.strip())
            r[0] += n
            r[1] += len(PUNCTUATION.findall(t))
            r[2] += n * linked
        r[3] += 1
    out = {}
    for container, keys in runs.items():
        a = np.array([sums[k] for k in keys], dtype=float)
        ratio, marks = _smooth(a[:, 0] / a[:, 3]), _smooth(a[:, 1] / a[:, 3])
        links = a[:, 2] / a[:, 0]
        fused = np.sqrt(ratio * (1 + marks)) * np.maximum(1 - links, SIDE)
        for k, f, share, n in zip(keys, fused.tolist(), links.tolist(), a[:, 0].tolist()):
            out[k] = Path(f * k[1], share, int(n), k[1], container)
    return out


def _around(hits: list[Path], containers: dict[str, tuple[str, bool]]) -> tuple[dict[str, float], dict[str, float]]:
    """(containers whose text belongs to that of the hits, all containers around
    the hits), each with the least weight of the hits inside."""
    chains = {}
    for h in hits:
        chain = [h.container]
        while chain[-1]:
            chain.append(containers[chain[-1]][0])
        chains[h.container] = chain
    common = next(c for c in max(chains.values(), key=len) if all(c in x for x in chains.values()))
    belong: dict[str, float] = {}
    outer: dict[str, float] = {}
    for h in hits:
        chain = chains[h.container]
        declared = [i for i, c in enumerate(chain) if c and containers[c][1]]
        last = declared[0] if declared else chain.index(common)
        for i, c in enumerate(chain):
            outer[c] = min(outer.get(c, h.weight), h.weight)
            if i <= last:
                belong[c] = min(belong.get(c, h.weight), h.weight)
    return belong, outer


def main_text(page: str | None) -> str:
    """The page's main text, one line per block; empty if there is none."""
    blocks, containers = text_blocks(page or "")
    scores = path_scores(blocks)
    mass = sum(p.chars * p.weight for p in scores.values())
    if not mass:
        return ""
    threshold = THRESHOLD * sum(p.score * p.chars * p.weight for p in scores.values()) / mass
    hits = {k: p for k, p in scores.items() if p.score >= threshold}
    belong, outer = _around(list(hits.values()), containers)

    def chosen(b: Block) -> bool:
        key = (b.path, b.weight)
        if key in hits:
            return True
        if b.container in belong and b.weight >= belong[b.container]:
            return scores[key].links <= 0.5 or b.tag in HEADINGS or b.tag in ("p", "blockquote")
        return b.tag == "h1" and b.weight >= outer.get(b.container, np.inf)

    lines = (" ".join("".join(t for t, _ in b.texts).split()) for b in blocks if chosen(b))
    return "\n".join(x for x in lines if x)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``.

    A null or empty page, or one without main text, has the empty text. Null
    ids and urls pass through; repeated rows come out once each; pages are
    worked on whole; other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType),
                           T.StructField("url", pages.schema[url_col].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return ready(pages).select(id_col, url_col, html_col).mapInArrow(run, schema)
