"""Main text of web pages as a maximum-scoring subsequence.

A page is read as a sequence of words and tags. A word scores the share of words in the
same kind of element that lie in the article of labelled pages, a tag costs by the share of
its kind that lies outside. A linear scan finds the contiguous stretch with the greatest
sum; its blocks of text are the main text. Elements that never belong to an article,
wherever they stand, are left out of the sequence. Labelled pages are those that mark
their article with ``<article>``.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, table, texts
from orcaspark.session import stage

# Elements whose content is no text of the page: raw text, up to the end of the page if unclosed,
# and others, which end at their own tag if they are self-closed or unclosed.
HIDDEN = "script|style|title|textarea|iframe"
HIDDEN_IF_CLOSED = frozenset("noscript template select svg math object video audio canvas button".split())
# Elements that never belong to an article's text, wherever they stand.
OUTSIDE = frozenset("nav header footer aside form menu dialog".split())
# The same by whole names of class, id and role; parts of names only bear on the weights.
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " cookie-notice cookie-banner cookie-consent popup modal overlay newsletter subscribe sidebar menu navbar nav navigation breadcrumb breadcrumbs"
    " pagination pager share sharing social related recommended comment comments disqus replies reply respond footer"
    " header masthead toolbar widget complementary contentinfo search searchbox login".split()
)
# Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
# Elements that are tracked as surroundings of a text, but html and body.
HOLDERS = (BLOCKS - {"p", "hr", "html", "body"}) | {"a"}
# An opening tag of these ends an open one of the same kind.
SELF_CLOSING = frozenset("p li dd dt tr td th option h1 h2 h3 h4 h5 h6".split())

# A quote begins a value only after an equals sign, and only if it is closed; without one a tag ends before the next.
# Nothing is given back once matched, so every part of a page is read a bounded number of times.
ATTRIBUTES = r"""(?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<({HIDDEN})\b{ATTRIBUTES}>.*?(?:</\1\b[^>]*>|\Z)"""
    rf"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({ATTRIBUTES})>|<[!?][^<>]*+>""",
    re.S | re.I,
)
NAMING = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
LABEL = re.compile(r"<article\b", re.I)
NAME_WORD = re.compile(r"[a-z]+")

#: Cost of a tag that only occurs outside articles, and what every tag costs at least.
TAG_COST, LEAST_COST = 3.25, 0.02
#: A kind of element gets a weight of its own if this share of the labelled pages has it;
#: this bounds the table of weights by the kinds on a page over this share.
COMMON = 0.001
#: Weight of kinds without one.
UNSEEN = 0.5


@dataclass
class Block:
    """A block of text: the tags before it, its words by surroundings, and its pieces."""

    tags: list[str]
    runs: list[tuple[tuple[str, ...], int]] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    outside: bool = False
    labelled: bool = False

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


@dataclass(frozen=True)
class Holder:
    tag: str
    names: tuple[str, ...]
    outside: bool


def holder(tag: str, attributes: str) -> Holder:
    words, names = [], []
    if attributes:
        for match in NAMING.finditer(attributes):
            value = (match[1] or match[2] or match[3] or "").lower()
            words += NAME_WORD.findall(value)
            names += value.split()
    outside = tag in OUTSIDE or not OUTSIDE_NAMES.isdisjoint(names)
    return Holder(tag, (tag, *(f"{tag}.{w}" for w in words)), outside)


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, read leniently: unclosed and stray tags are allowed."""
    found, stack, tags, place = [], [], [], 0
    current: dict[bool, Block] = {}  # by whether its pieces lie outside
    endless = set()

    def add(raw: str) -> None:
        nonlocal tags
        text = references.unescape(raw) if "&" in raw else raw
        words = len(text.split())
        outside = any(h.outside for h in stack)
        if words:
            if outside not in current:
                own = current[outside] = Block([] if outside else tags, outside=outside)
                own.labelled = not outside and any(h.tag == "article" for h in stack)
                found.append(own)
                tags = tags if outside else []
            current[outside].runs.append((tuple(n for h in stack for n in h.names), words))
        if outside in current:
            current[outside].pieces.append(text)

    while match := TOKEN.search(page, place):
        if match.start() > place:
            add(page[place : match.start()])
        place = match.end()
        if not match[3]:  # a comment, a declaration or a hidden element
            continue
        tag = match[3].lower()
        if tag == "br":
            for own in current.values():
                own.pieces.append(" ")
            continue
        if tag in HIDDEN_IF_CLOSED:
            if not match[2] and not match[4].endswith("/") and tag not in endless:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, place)
                if end:
                    place = end.end()
                else:
                    endless.add(tag)
            continue
        if tag in BLOCKS:
            current.clear()
        outside = any(h.outside for h in stack)
        if match[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
        elif tag in HOLDERS or tag == "p":
            if tag in SELF_CLOSING and stack and stack[-1].tag == tag:
                stack.pop()
            if stack and stack[-1].tag == "p" and tag in BLOCKS:
                stack.pop()
            if not match[4].endswith("/"):
                stack.append(holder(tag, match[4]))
        if not outside and not any(h.outside for h in stack):
            tags.append(tag)
    if place < len(page):
        add(page[place:])
    return found


@dataclass(frozen=True)
class Weights:
    """Share of words by kind of surroundings, and of tags by name, that lie in articles."""

    words: dict[str, float]
    tags: dict[str, float]

    def score(self, block: Block) -> tuple[float, float]:
        """What the tags before a block cost, and what its words score; nothing where no text is wanted."""
        if block.outside:
            return 0.0, 0.0
        cost = sum(LEAST_COST + TAG_COST * (1 - self.tags.get(t, UNSEEN)) for t in block.tags)
        words = sum(n * min((self.words.get(k, UNSEEN) for k in kinds), default=UNSEEN) for kinds, n in block.runs)
        return cost, words


def best_stretch(scores: list[tuple[float, float]]) -> tuple[int, int]:
    """First and last+1 of the blocks between which words minus tags are greatest; the earliest such stretch."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, (cost, words) in enumerate(scores):
        if total - cost <= 0:
            total, start = 0.0, i  # the stretch begins behind the block's tags
        else:
            total -= cost
        total += words
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str, weights: Weights) -> str:
    """Blocks of the best stretch, joined by empty lines; empty if the page has no words."""
    read = blocks(page)
    start, stop = best_stretch([weights.score(b) for b in read])
    return "\n\n".join(b.text() for b in read[start:stop] if not b.outside)


def learn(pages: DataFrame) -> Weights:
    """Weights from all labelled rows of ``pages``.

    Counts are summed per batch, then by kind; the driver gets the kinds common enough
    for a weight. Without labelled pages every word and tag has the weight ``UNSEEN``.
    """

    def convert(batch: pa.RecordBatch) -> dict:
        inside, total, pages_of = Counter(), Counter(), Counter()
        for page in texts(batch["html"]):
            if LABEL.search(page):
                seen = {("page", "")}
                for block in blocks(page):
                    counted = [("tag", t, 1) for t in block.tags]
                    counted += [("word", k, n) for kinds, n in block.runs for k in set(kinds)]
                    for kind, name, n in counted:
                        total[kind, name] += n
                        inside[kind, name] += n * block.labelled
                        seen.add((kind, name))
                pages_of.update(seen)
        keys = list(pages_of)
        return {
            "kind": pa.array([k for k, _ in keys], pa.string()),
            "name": pa.array([n for _, n in keys], pa.string()),
            "inside": pa.array([inside[k] for k in keys], pa.int64()),
            "total": pa.array([total[k] for k in keys], pa.int64()),
            "pages": pa.array([pages_of[k] for k in keys], pa.int64()),
        }

    counts = stage(
        per_batch(pages.select("html"), convert, "kind string, name string, inside bigint, total bigint, pages bigint")
        .groupBy("kind", "name")
        .agg(*(F.sum(c).alias(c) for c in ("inside", "total", "pages"))),
        "kinds",
    )
    labelled = counts.filter(F.col("kind") == "page").first()
    least = COMMON * labelled["pages"] if labelled else 0
    rows = counts.filter((F.col("kind") != "page") & (F.col("pages") >= least)).collect()
    share = {(r["kind"], r["name"]): (r["inside"] + 0.01) / (r["total"] + 0.02) for r in rows}
    return Weights(
        {name: s for (kind, name), s in share.items() if kind == "word"},
        {name: s for (kind, name), s in share.items() if kind == "tag"},
    )


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Main text of every row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars``.

    Reads ``page_id``, ``url`` and ``html`` only. A null or empty html has an empty text.
    Repeated rows come out as often. Whole pages are read; no shuffle but that of the
    weights' counts.
    """
    weights = weights or learn(pages)

    def convert(batch: pa.RecordBatch) -> dict:
        found = [main_text(page, weights) for page in texts(batch["html"])]
        return {
            "page_id": batch["page_id"],
            "url": batch["url"],
            "text": pa.array(found, pa.string()),
            "n_chars": pa.array([len(t) for t in found], pa.int64()),
        }

    return per_batch(pages.select("page_id", "url", "html"), convert, "page_id bigint, url string, text string, n_chars bigint")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
