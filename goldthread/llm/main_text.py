"""The main text of web pages by tag-path ratios.

A text node belongs to the path of open tags from the root down to it. Per path of a page the characters and punctuation
marks are added up; their ratios to the number of nodes are smoothed over the nodes in page order and fused into one score, lowered
where a path holds several links and little else. What the markup says about a node are further terms of its score: a marked
article raises it, tags, roles and names of boilerplate (menus, page headers, footers, sidebars, notices, adverts, forms, comments)
lower it, strongly on a container that is named so, weakly on a paragraph or where the name has other words too. A block of
text is kept when the mean score of its nodes reaches a share of the page's best. Only what is never read is cut: scripts, styles,
form controls, media and hidden parts.

Marked articles compete: one that has at least ``RIVAL`` of the text of the largest, and of the unnamed text outside, is the
article (there may be several); beside it the limit is a small share, so that its short blocks stay. If none wins, the ratios of all paths
decide, and several articles that lost are teasers.

Pages are independent of each other: no shuffle, and a task holds one batch of pages. A helper parses a page in one pass; time and
memory are linear in its length.

Defined cases: a null or empty html has an empty text; broken markup is read as far as it goes (open elements end with their parent, a
lone ``<`` is text); where all text is named boilerplate, what is in an article, or on a page without one what is no link, competes; repeated rows
are extracted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import log1p
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from goldthread.llm.words import pieces

KEEP = 0.25
KEEP_BESIDE_ARTICLE = 0.04
ARTICLE_BONUS = 40.0
RIVAL = 0.5
TEASER = 0.2
NAMED, NAMED_BLOCK, PARTLY, PARTLY_BLOCK = 0.01, 0.03, 0.15, 0.6  # a container or a block of text, named so entirely or in part
KERNEL = (0.25, 0.5, 0.25)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split())
ENDS_PARAGRAPH = BLOCKS - frozenset("body caption html tbody td tfoot th thead tr".split())
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
SCOPES = frozenset("ul ol dl table select div section article body html".split())
CUT = frozenset((
    "audio button canvas datalist embed head iframe map noscript object optgroup option script select style svg template textarea title video"
).split())
BOILERPLATE = frozenset("aside dialog footer form menu nav".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NAMES = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "alerts popup modal overlay newsletter subscribe subscription signup login share sharing social breadcrumb breadcrumbs pagination pager "
    "related recommended recommendations comment comments discussion disqus replies reply respond nav navbar navigation menu submenu sidebar "
    "aside footer toolbar widget widgets masthead copyright disclaimer skip search"
).split())
COMMENTS = frozenset("comment comments discussion disqus replies reply respond ad ads advert advertisement sponsored related".split())
COMMON = frozenset((
    "area bar block box bottom button buttons container content global icon icons inner left link links main outer page panel right section "
    "site slot text title to tools top unit wrap wrapper zone"
).split())
ARTICLE = frozenset(("article", "main"))
TEXT_BLOCKS = frozenset("a b blockquote dd dt em figcaption h1 h2 h3 h4 h5 h6 i li p pre span strong td th".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")


def _weight(tag: str, attributes: str, in_article: bool) -> float:
    """The factor that a start tag puts on the scores of what it holds; 0 for what is hidden."""
    weight = NAMED if tag in BOILERPLATE or tag == "header" and not in_article else 1.0
    if "=" not in attributes:
        return 0.0 if "hidden" in attributes and re.search(r"(?:^|\s)hidden(?:\s|/|$)", attributes) else weight
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if values.get("aria-hidden") == "true" or "hidden" in values or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", "")):
        return 0.0
    if tag in ("html", "body"):
        return weight
    if values.get("role", "").lower() in ROLES:
        weight = NAMED
    words = {w.lower() for w in _NAME.findall(f"{values.get('class', '')} {values.get('id', '')}")}
    known = NAMES if in_article or tag in ARTICLE else NAMES | {"header"}
    if not words & known:
        return weight
    entirely = words <= known | COMMON
    if tag in TEXT_BLOCKS:
        return min(weight, NAMED_BLOCK if entirely else PARTLY_BLOCK)
    if tag in ARTICLE:
        return min(weight, NAMED if words & COMMENTS else 1.0)
    return min(weight, NAMED if entirely or words & COMMENTS else PARTLY)


class _Node(NamedTuple):
    block: int
    path: int
    text: str
    linked: bool
    article: int  # number of the outermost article or main element around it, 0 for none
    weight: float


class _Page:
    """The text nodes of a page."""

    def __init__(self, html: str):
        self.nodes: list[_Node] = []
        self.paths: dict[tuple[int, str], int] = {}
        self.stack: list[tuple[str, int, float, int]] = [("", 0, 1.0, 0)]  # tag, path, weight (0: cut), article
        self.articles = 0
        self.block = 0
        at = 0
        while (m := _MARKUP.search(html, at)) is not None:
            self._text(html[at:m.start()])
            at = m.end()
            if m[1]:
                self._close(m[1].lower())
            elif m[2] or m[4]:
                tag, attributes = (m[2] or m[4]).lower(), m[3] or m[5] or ""
                if tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                    at = end.start() if end else len(html)
                self._open(tag, attributes)
        self._text(html[at:])

    def _text(self, raw: str) -> None:
        _, path, weight, article = self.stack[-1]
        if raw and weight:
            self.nodes.append(_Node(self.block, path, unescape(raw), any(s[0] == "a" for s in self.stack[-3:]), article, weight))

    def _pop_to(self, index: int) -> None:
        del self.stack[index:]

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        if tag in ENDS_PARAGRAPH or tag in SIBLINGS:
            ends = SIBLINGS.get(tag, set()) | ({"p"} if tag in ENDS_PARAGRAPH else set())
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] in ends:
                    self._pop_to(i)
                    break
                if self.stack[i][0] in SCOPES:
                    break
        if tag in VOID:
            if tag == "br":
                self._text(" ")
            return
        _, path, weight, article = self.stack[-1]
        if tag in CUT and attributes.endswith("/"):
            return
        weight *= 0.0 if tag in CUT else _weight(tag, attributes, article > 0)
        if tag in ARTICLE and weight and not article:
            self.articles += 1
            article = self.articles
        here = self.paths.setdefault((path, tag), len(self.paths) + 1)
        self.stack.append((tag, here, weight, article))

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self._pop_to(i)
                return
            if tag not in BLOCKS and self.stack[i][0] in SCOPES:
                return


def path_scores(nodes: list[_Node]) -> list[float]:
    """The fused, smoothed ratio of each node's path. A path of links alone is not smoothed: a menu stays low beside a paragraph, and the
    lower the more links it has."""
    totals: dict[int, list[float]] = {}
    for node in nodes:
        total = totals.setdefault(node.path, [0, 0, 0, 0])
        length = len(node.text.strip())
        for k, v in enumerate((1, length, len(_PUNCTUATION.findall(node.text)), length * node.linked)):
            total[k] += v
    fused = {}
    for path, (n, length, marks, linked) in totals.items():
        share = linked / length
        fused[path] = (log1p(length / n) + log1p(marks / n)) * (1 - share * (1 - 1 / n)) ** 2, share > 0.5
    raw = [fused[node.path][0] for node in nodes]
    edged = [raw[0], *raw, raw[-1]]
    smooth = [sum(w * edged[i + k] for k, w in enumerate(KERNEL)) for i in range(len(raw))]
    return [r if fused[node.path][1] else s for r, s, node in zip(raw, smooth, nodes)]


def _winners(nodes: list[_Node], articles: int) -> tuple[set[int], bool]:
    """The articles that hold the page's text, and whether all others are teasers."""
    mass = [0.0] * (articles + 1)
    for node in nodes:
        if not node.linked:
            mass[node.article] += len(node.text.strip()) * node.weight
    best = max(mass[1:], default=0.0)
    won = {i for i in range(1, articles + 1) if mass[i] >= RIVAL * best and mass[i] >= RIVAL * mass[0] and mass[i] > 0}
    return won, not won and articles > 1


def main_text(html: str | None, keep: float = KEEP, keep_beside_article: float = KEEP_BESIDE_ARTICLE) -> str:
    page = _Page(html) if html else None
    full = [n for n in page.nodes if n.text.strip()] if page else []
    if full and max(n.weight for n in full) <= PARTLY:  # nothing but named boilerplate
        full = [n for n in full if n.article] if page.articles else [n for n in full if not n.linked]
    if not full:
        return ""
    won, teasers = _winners(full, page.articles)
    blocks: dict[int, list[float]] = {}
    for node, score in zip(full, path_scores(full)):
        term = ARTICLE_BONUS if node.article in won else TEASER if teasers and node.article else 1.0
        held = blocks.setdefault(node.block, [0.0, 0.0])
        held[0] += score * node.weight * term * len(node.text)
        held[1] += len(node.text)
    means = {b: total / weight for b, (total, weight) in blocks.items()}
    least = (keep_beside_article if won else keep) * max(means.values())
    texts: dict[int, list[str]] = {}
    for node in page.nodes:
        if means.get(node.block, -1.0) >= least:
            texts.setdefault(node.block, []).append(node.text)
    return "\n".join(" ".join("".join(parts).split()) for parts in texts.values())


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in (piece for whole in batches for piece in pieces(whole)):
        yield batch[["page_id", "url"]].assign(text=[main_text(h) for h in batch["html"]])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (empty if none) and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    texts = rows.mapInPandas(_extract, "page_id string, url string, text string")
    return texts.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
