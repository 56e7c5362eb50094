"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every
match must contain. A segment of documents (one Arrow batch, cut by bytes) gets an
inverted index of the trigrams that any rule asks for; postings are intersected and
united as the query says, and only the documents left are searched with the expression.
Rules without a mandatory trigram read every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import product
from re import _constants as codes
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, raw_texts, table

#: Bytes of text that one segment's index covers; a longer document is a segment of its own.
SEGMENT_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


BASE_RULES = (
    Rule(
        "assign",
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Published shapes of further credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})"),
    Rule("slack", r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"\b[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@[^\s/@]+"),
)
RULES = BASE_RULES + MORE_RULES


# -- Boolean trigram queries ---------------------------------------------------------
#
# A query is ALL, a trigram, or ("and" | "or", frozenset of queries).

ALL = "ALL"
#: Alternatives of a literal part that are listed before it counts as unknown.
LISTED = 24


def both(*queries):
    """Conjunction."""
    parts = frozenset(q for q in queries if q is not ALL)
    return ALL if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def either(*queries):
    """Disjunction."""
    parts = frozenset(queries)
    return ALL if ALL in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", parts)


def grams(strings: Iterable[bytes]):
    """Query for texts that contain one of the strings."""
    return either(*(both(*(s[i : i + 3] for i in range(len(s) - 2))) if len(s) > 2 else ALL for s in strings))


@dataclass(frozen=True)
class Part:
    """What is known of the texts a part of an expression matches.

    ``whole`` lists them all, if that is possible. Otherwise they begin with one of
    ``head``, end with one of ``tail`` and satisfy ``query``.
    """

    whole: frozenset[bytes] | None
    head: frozenset[bytes] = frozenset({b""})
    tail: frozenset[bytes] = frozenset({b""})
    query: object = ALL

    def open(self) -> Part:
        if self.whole is None:
            return self
        return Part(
            None,
            frozenset(s[:2] for s in self.whole),
            frozenset(s[-2:] for s in self.whole),
            grams(self.whole),
        )


EMPTY = Part(frozenset({b""}))
UNKNOWN = Part(None)


def then(a: Part, b: Part) -> Part:
    if a.whole is not None and b.whole is not None and len(a.whole) * len(b.whole) <= LISTED:
        return Part(frozenset(x + y for x, y in product(a.whole, b.whole)))
    x, y = a.open(), b.open()
    seam = grams({p + q for p, q in product(x.tail, y.head)})
    head, tail = x.head, y.tail
    if a.whole is not None and len(a.whole) * len(y.head) <= LISTED:
        seam = both(seam, grams({p + q for p, q in product(a.whole, y.head)}))
        head = frozenset((p + q)[:2] for p, q in product(a.whole, y.head))
    if b.whole is not None and len(b.whole) * len(x.tail) <= LISTED:
        seam = both(seam, grams({p + q for p, q in product(x.tail, b.whole)}))
        tail = frozenset((p + q)[-2:] for p, q in product(x.tail, b.whole))
    return Part(None, head, tail, both(x.query, y.query, seam))


def alternatives(parts: list[Part]) -> Part:
    if all(p.whole is not None for p in parts):
        union = frozenset().union(*(p.whole for p in parts))
        if len(union) <= LISTED:
            return Part(union)
    parts = [p.open() for p in parts]
    head = frozenset().union(*(p.head for p in parts))
    tail = frozenset().union(*(p.tail for p in parts))
    none = frozenset({b""})
    return Part(
        None,
        head if len(head) <= LISTED else none,
        tail if len(tail) <= LISTED else none,
        either(*(p.query for p in parts)),
    )


def character(code: int, flags: int) -> Part:
    """A literal, with A-Z as a-z; letters with case partners beyond ASCII are unknown."""
    letter = chr(code)
    if flags & re.IGNORECASE and not flags & re.ASCII and (code > 127 or letter in "kKsS"):
        return UNKNOWN
    return Part(frozenset({(letter.lower() if code < 128 else letter).encode("utf-8", "surrogatepass")}))


def analyse(tree, flags: int) -> Part:
    known = EMPTY
    for op, value in tree:
        known = then(known, _node(op, value, flags))
    return known


def _node(op, value, flags: int) -> Part:
    if op is codes.LITERAL:
        return character(value, flags)
    if op is codes.IN:
        listed = []
        for kind, item in value:
            if kind is codes.LITERAL:
                listed.append(item)
            elif kind is codes.RANGE and item[1] - item[0] < LISTED:
                listed += range(item[0], item[1] + 1)
            else:
                return UNKNOWN
        return alternatives([character(c, flags) for c in listed])
    if op is codes.SUBPATTERN:
        _, add, drop, inner = value
        return analyse(inner, (flags | add) & ~drop)
    if op is codes.BRANCH:
        return alternatives([analyse(branch, flags) for branch in value[1]])
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT):
        low, high, inner = value
        one = analyse(inner, flags)
        if high == 1:
            return one if low else alternatives([EMPTY, one])
        if not low:
            return UNKNOWN
        known = EMPTY
        for _ in range(min(int(low), 3)):
            known = then(known, one)
        return known if low == high and low <= 3 else then(then(known, UNKNOWN), one)
    if op in (codes.AT, codes.ASSERT, codes.ASSERT_NOT):
        return EMPTY  # a place, without a character of its own
    return UNKNOWN


def trigram_query(pattern: str):
    """Boolean query over lower-cased UTF-8 trigrams that every match satisfies."""
    tree = parser.parse(pattern)
    return analyse(tree, tree.state.flags).open().query


def trigrams(query) -> set[bytes]:
    if query is ALL:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams, query[1]))


# -- Index of a segment ----------------------------------------------------------------

LOWER = np.arange(256, dtype=np.int32)
LOWER[65:91] += 32


class Plan:
    """Rules with their queries, and the trigrams that an index must hold for them."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(rule, re.compile(rule.pattern), trigram_query(rule.pattern)) for rule in rules]
        wanted = sorted(set().union(*(trigrams(query) for _, _, query in self.rules)))
        self.slots = {gram: i + 1 for i, gram in enumerate(wanted)}
        self.slot_of = np.zeros(1 << 24, dtype=np.uint16)
        for gram, slot in self.slots.items():
            self.slot_of[int.from_bytes(gram, "big")] = slot

    def postings(self, documents: list[bytes]) -> dict[int, np.ndarray]:
        """Inverted index of a segment: slot of a trigram to the ordinals of its documents."""
        data = LOWER[np.frombuffer(b"".join(documents), dtype=np.uint8)]
        ends = np.cumsum([len(d) for d in documents])
        if not self.slots or len(data) < 3:
            return {}
        slots = self.slot_of[(data[:-2] << 16) | (data[1:-1] << 8) | data[2:]]
        places = np.flatnonzero(slots)
        owners = np.searchsorted(ends, places, side="right")
        inside = places + 3 <= ends[owners]
        pairs = np.unique(slots[places[inside]].astype(np.int64) * len(documents) + owners[inside])
        found, ordinals = np.divmod(pairs, len(documents))
        cuts = np.flatnonzero(np.diff(found)) + 1
        return {int(s[0]): o for s, o in zip(np.split(found, cuts), np.split(ordinals, cuts), strict=True) if len(s)}

    def candidates(self, query, postings: dict[int, np.ndarray], everything: np.ndarray) -> np.ndarray:
        if query is ALL:
            return everything
        if isinstance(query, bytes):
            return postings.get(self.slots[query], everything[:0])
        lists = [self.candidates(q, postings, everything) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        lists.sort(key=len)
        left = lists[0]
        for other in lists[1:]:
            left = np.intersect1d(left, other, assume_unique=True)
        return left

    def spans(self, documents: list[bytes]) -> list[list[tuple[int, int, str]]]:
        """Per document: start, end and kind of each secret, by start, then by rule."""
        postings, everything = self.postings(documents), np.arange(len(documents))
        found: list[list] = [[] for _ in documents]
        decoded: dict[int, str] = {}
        for order, (rule, expression, query) in enumerate(self.rules):
            for i in self.candidates(query, postings, everything).tolist():
                if i not in decoded:
                    decoded[i] = documents[i].decode()
                for match in expression.finditer(decoded[i]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[i].append((match.start(), order, match.end(), rule.kind))
        return [[(start, end, kind) for start, _, end, kind in sorted(f)] for f in found]


@lru_cache(maxsize=4)
def plan_of(rules: tuple[Rule, ...]) -> Plan:
    return Plan(rules)


def segments(documents: list[bytes]) -> Iterable[list[bytes]]:
    segment, size = [], 0
    for document in documents:
        if segment and size + len(document) > SEGMENT_BYTES:
            yield segment
            segment, size = [], 0
        segment.append(document)
        size += len(document)
    if segment:
        yield segment


def masked(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """``text`` with every stretch that spans cover, overlapping ones joined, replaced by ``mask``."""
    out, place = [], 0
    for start, end, _ in spans:
        if start >= place:
            out += [text[place:start], mask]
        place = max(place, end)
    return "".join([*out, text[place:]])


SPANS = "array<struct<start: bigint, end: bigint, kind: string>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str | None = None) -> DataFrame:
    """``docs`` with a column ``spans`` (an input column of that name is replaced).

    Spans count code points, the end is exclusive; they are ordered by start, then by the
    order of ``rules``. Null and empty texts have none. Every input row comes out once, so
    repeated rows and null ids need no care. With ``mask`` the spans in ``text`` are
    replaced by it. No shuffle; memory is bounded by a batch and a segment.
    """
    kept = [f for f in docs.schema.fields if f.name != "spans"]

    def convert(batch: pa.RecordBatch) -> dict:
        plan = plan_of(rules)
        documents = raw_texts(batch["text"])
        found = [spans for part in segments(documents) for spans in plan.spans(part)]
        out = {f.name: batch[f.name] for f in kept}
        if mask is not None:
            changed = [masked(d.decode(), s, mask) if s else None for d, s in zip(documents, found, strict=True)]
            out["text"] = pa.array(
                [t if c is None else c for c, t in zip(changed, batch["text"].to_pylist(), strict=True)], pa.string()
            )
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
        rows = [[{"start": a, "end": b, "kind": k} for a, b, k in spans] for spans in found]
        return out | {"spans": pa.array(rows, pa.list_(kind))}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return per_batch(docs.select(*[f"`{f.name}`" for f in kept]), convert, f"{schema}, spans {SPANS}")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: counts and digest of the base kinds, and all spans."""
    spans = F.col("spans")
    kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))
    counts = [F.size(_of_kind(spans, kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds]
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans")
    )


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)
