"""Mixing sources to target weights by Sainte-Laguë apportionment.

A source's documents are dealt to shards of bounded size by a seeded hash. The mix is
counted in blocks of equally many words. Blocks go to the sources by the highest
quotients ``target / (2 * seats + 1)``, then from each source to groups of its shards and
from each group to its shards by their words. Within a shard the documents stand in a
seeded order, and a seeded run of blocks is taken, around the end and over again as long
as the quota lasts.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, plain_names, table
from orcaspark.session import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words of a block; documents and words of a shard; shards of a group.
BLOCK, SHARD_DOCS, SHARD_WORDS, GROUP = 16, 512, 1 << 18, 1024
#: Weights of the sources in their order, repeated.
WEIGHTS = (1, 2, 3)
#: No source and no document counts more often than this.
REPEATS = 3

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, *range(9, 14)]] = False
_SLICE = 4 << 20


def word_counts(column: pa.Array) -> np.ndarray:
    """Words of each text of a string column; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    counts, row = np.zeros(len(column), dtype=np.int64), 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SLICE, side="right")) - 1)
        stop = min(stop, len(column))
        begin, end = offsets[row], offsets[stop]
        is_word = _IS_WORD[data[begin:end]]
        starts = is_word.copy()
        starts[1:] &= ~is_word[:-1]
        edges = offsets[row : stop + 1] - begin
        inner = edges[:-1][edges[:-1] < end - begin]
        starts[inner] = is_word[inner]
        sums = np.concatenate([[0], np.cumsum(starts, dtype=np.int64)])
        counts[row:stop] = sums[edges[1:]] - sums[edges[:-1]]
        row = stop
    return counts


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the words of ``text``, which is counted and not kept."""
    kept = [f for f in docs.schema.fields if f.name not in ("text", "size")]

    def convert(batch: pa.RecordBatch) -> dict:
        return {f.name: batch[f.name] for f in kept} | {"size": pa.array(word_counts(batch["text"]))}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return per_batch(docs.select(*[f"`{f.name}`" for f in kept], "text"), convert, f"{schema}, size bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per source: ``source``, its number ``src``, ``source_size``, ``target`` and ``shards``.

    Sources are numbered by code point, null last. All words are shared by weight; a
    target stops at ``repeats`` times its source's words, and the excess goes to the others
    by weight. With ``level`` words per unit of weight the targets are
    ``min(cap, weight * level)``; ordered by cap per weight, the level is that of the
    first source whose cap it does not reach. Works on the grouped sources only.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy("ratio", "src")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int"))
    free = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    return (
        sources.withColumn("src", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onwards))
        .withColumn("level", F.first(free, ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select(
            "source",
            "src",
            "source_size",
            F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.lit(0.0))).alias("target"),
            F.greatest(
                F.ceil(F.col("docs") / SHARD_DOCS), F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)
            ).cast("bigint").alias("shards"),
        )
    )


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by the highest quotients ``votes / (2 * seats + 1)``; equal quotients go to the first.

    Starts from the rounded shares, which are such an allocation for their own total, and
    adds or takes back single seats by quotient. Without votes nobody has a seat.
    """
    votes = np.asarray(votes, dtype=np.float64)
    total = votes.sum()
    if total <= 0 or seats <= 0:
        return np.zeros(len(votes), dtype=np.int64)
    got = np.floor(votes * (seats / total) + 0.5).astype(np.int64)
    missing = int(seats - got.sum())
    if missing > 0:
        heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if v > 0]
    else:
        heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if g > 0]
    heapq.heapify(heap)
    step = 1 if missing > 0 else -1
    for _ in range(abs(missing)):
        _, at = heapq.heappop(heap)
        i = abs(at)
        got[i] += step
        if step > 0:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
        elif got[i] > 0:
            heapq.heappush(heap, (votes[i] / (2 * got[i] - 1), -i))
    return got


def _deal(frame: DataFrame, parent: list[str], child: str, votes: str, seats: str) -> DataFrame:
    """Deal each parent's ``seats`` to its children by ``votes``: adds ``quota``. Children fit in memory."""

    def deal(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(child, kind="stable")
        return part.assign(quota=sainte_lague(part[votes].to_numpy(), int(part[seats].iloc[0])))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return frame.groupBy(*parent).applyInPandas(deal, f"{schema}, quota bigint")


def quotas(sizes: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of every shard: ``src``, ``shard``, ``quota``.

    ``sizes`` has ``src``, ``shard`` and ``size`` per document. Sources get blocks by
    their targets, groups of shards and shards by their words.
    """
    shards = stage(
        sizes.groupBy("src", "shard").agg(F.sum("size").alias("words"))
        .withColumn("group", F.floor(F.col("shard") / GROUP)),
        "shards",
    )
    seats = F.round(F.sum("target").over(Window.partitionBy("one")) / block).cast("bigint")
    of_sources = _deal(
        sources.select(F.lit(0).alias("one"), "src", "target").withColumn("seats", seats), ["one"], "src", "target", "seats"
    ).select("src", F.col("quota").alias("seats"))
    groups = shards.groupBy("src", "group").agg(F.sum("words").alias("words")).join(of_sources, "src")
    of_groups = _deal(groups, ["src"], "group", "words", "seats").select("src", "group", F.col("quota").alias("seats"))
    return _deal(shards.join(of_groups, ["src", "group"]), ["src", "group"], "shard", "words", "seats").select(
        "src", "shard", "quota"
    )


def run_of_blocks(sizes: np.ndarray, quota: int, block: int, key: str) -> tuple[int, np.ndarray]:
    """What a shard's quota takes of its documents, which stand in their order.

    Returns how often every document is taken whole, and the ranges of words taken once
    more: an array of shape (documents, 2, 2), counted within the document, empty ranges
    with start = end. The run of blocks begins at a seeded block and goes around the end.
    """
    words, ranges = int(sizes.sum()), np.zeros((len(sizes), 2, 2), dtype=np.int64)
    if not words:
        return 0, ranges
    whole, rest = divmod(min(quota * block, REPEATS * words), words)
    seed = int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "big")
    first = seed % -(-words // block) * block
    begins = np.cumsum(sizes) - sizes
    for i, (a, b) in enumerate(((first, min(first + rest, words)), (0, max(0, first + rest - words)))):
        ranges[:, i, 0] = np.clip(a - begins, 0, sizes)
        ranges[:, i, 1] = np.maximum(np.clip(b - begins, 0, sizes), ranges[:, i, 0])
    return int(whole), ranges


def in_order(part: pa.Table, last: str) -> pa.Table:
    """A shard's rows by their seeded place, then by id and by one more column."""
    return part.take(pc.sort_indices(part, sort_keys=[(c, "ascending") for c in ("place", "doc_id", last)]))


def seed_of(part: pa.Table, seed: int) -> str:
    return f"{seed}:{part['src'][0].as_py()}:{part['shard'][0].as_py()}"


def plan(sizes: DataFrame, seed: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Sources with their targets, and quotas by shard, from a staged table of ``source``, ``doc_id``, ``size``."""
    sources = stage(targets(sizes), "sources")
    return sources, stage(quotas(dealt(sizes, sources, seed), sources, block), "quotas")


def dealt(docs: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``docs`` with their source's row and a shard; ``place`` orders them within it."""
    place = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id"), F.lit(-1)))
    return (
        docs.join(sources.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source")))
        .drop("its_source")
        .withColumn("place", place)
        .withColumn("shard", F.pmod(F.xxhash64("place"), F.col("shards")))
    )


def taken(docs: DataFrame, seed: int = 6, block: int = BLOCK) -> DataFrame:
    """How many words the mix takes of every row of ``docs``.

    Returns ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, one row per input
    row. Null texts and texts of white space have size 0 and nothing is taken of them; a
    null source is a source of its own; repeated rows are taken like other documents, and
    a null id is an id. An empty table gives an empty result. Reruns agree.
    """
    sizes = stage(sized(docs.select("doc_id", "source", "text")), "sizes")
    sources, by_shard = plan(sizes, seed, block)

    def take(part: pa.Table) -> pa.Table:
        part = in_order(part, "size")
        size = part["size"].to_numpy()
        whole, ranges = run_of_blocks(size, part["quota"][0].as_py(), block, seed_of(part, seed))
        more = (ranges[:, :, 1] - ranges[:, :, 0]).sum(axis=1)
        return part.select(["doc_id", "size", "source_size", "target"]).append_column("taken", pa.array(whole * size + more))

    rows = dealt(sizes, sources, seed).join(by_shard, ["src", "shard"])
    return rows.groupBy("src", "shard").applyInArrow(
        take, "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"
    )


def words_between(text: str, start: int, end: int) -> str:
    """From word ``start`` to before word ``end`` of a text, with what stands between them."""
    bounds = [m.span() for i, m in enumerate(WORD.finditer(text)) if i in (start, end - 1)]
    return text[bounds[0][0] : bounds[-1][1]]


def mix(docs: DataFrame, seed: int = 6, block: int = BLOCK) -> DataFrame:
    """The mixed documents, with the columns of ``docs``.

    A document taken several times comes out as often, and once more with the words of
    the part that was taken of it in the last round (two parts are joined by a line
    break). Where ``docs`` has ``n_chars`` it is counted anew for parts. Rows of which
    nothing is taken don't come out. Needs ``doc_id``, ``source``, ``text``.
    """
    docs, back = plain_names(docs, ("doc_id", "source", "text", "n_chars"))
    sizes = stage(sized(docs.select("doc_id", "source", "text")), "sizes")
    sources, by_shard = plan(sizes, seed, block)
    columns = docs.columns

    def take(part: pa.Table) -> pa.Table:
        part = in_order(part, "text")
        size = word_counts(part["text"].combine_chunks())
        whole, ranges = run_of_blocks(size, part["quota"][0].as_py(), block, seed_of(part, seed))
        texts, rows = [], []
        for i, text in enumerate(part["text"].to_pylist()):
            if size[i]:
                spans = [(a, b) for a, b in ranges[i].tolist() if b > a]
                once = [text] if sum(b - a for a, b in spans) == size[i] else []
                if spans and not once:
                    once = ["\n".join(words_between(text, a, b) for a, b in sorted(spans))]
                texts += [text] * whole + once
                rows += [i] * (whole + len(once))
        out = part.select(columns).take(pa.array(rows, pa.int64()))
        out = out.set_column(columns.index("text"), "text", pa.array(texts, pa.string()))
        if "n_chars" in columns:
            out = out.set_column(columns.index("n_chars"), "n_chars", pa.array([len(t) for t in texts], pa.int64()))
        return out

    docs = dealt(docs, sources.select("source", "src", "shards"), seed).join(by_shard, ["src", "shard"])
    return back(docs.groupBy("src", "shard").applyInArrow(take, docs.select(*columns).schema))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return taken(table(spark, sf_dir, "documents"))
