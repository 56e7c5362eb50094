"""Near-duplicate vectors through a robust-pruned flat graph.

Vectors are dealt to overlapping shards by their nearest centroids. In each shard a
robust-pruned graph is built; the adjacency lists that a vector got in different shards
are united, and from each shard's medoid a greedy search, which goes on from everything
within an expanded range, looks for each member's near ones. What it finds is verified by
the exact cosine. An audit against brute force measures recall and widens the overlap
until it suffices.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, table
from orcaspark.llm.graph import components
from orcaspark.llm.vectors import (
    MOST_CENTROIDS,
    FlatGraph,
    balanced_centroids,
    blocks_of,
    edges_of,
    robust_pruned,
    sample,
    squared,
    usable,
)
from orcaspark.session import stage

#: Least cosine of a link, and how far below it the search goes on.
COSINE, SLACK = 0.95, 0.05
#: Vectors of a shard aimed at, and at most in a part of one.
SHARD, PART = 1024, 1024
#: Shards of a vector at first; points of the search's beam.
OVERLAP, BEAM = 3, 24
#: Vectors audited at first, and as a matrix at a time; true links that make a measure; the recall that suffices.
AUDITED, MATRIX, MEASURED, RECALL = 200, 2048, 400, 0.98


def nodes_of(rows: DataFrame) -> DataFrame:
    """Distinct vectors: ``key`` (hash of the components), ``vec_id`` (smallest), ``copies``, ``unit``."""
    once = rows.groupBy("key", "vec_id").agg(F.any_value("vector").alias("vector"))
    return once.groupBy("key").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.any_value("vector").alias("unit")
    )


def keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``key`` and unit ``vector`` of usable rows."""

    def convert(batch: pa.RecordBatch) -> dict:
        rows = [np.asarray(v) for v in batch["vector"].to_pylist()]
        return {
            "vec_id": batch["vec_id"],
            "key": pa.array([hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in rows], pa.binary()),
            "vector": pa.array([r / np.linalg.norm(r) for r in rows], pa.list_(pa.float64())),
        }

    return per_batch(usable(vectors), convert, "vec_id bigint, key binary, vector array<double>")


def members(nodes: DataFrame, centroids: np.ndarray, overlap: int) -> DataFrame:
    """Each node in the shards of its ``overlap`` nearest centroids: ``shard``, ``key``, ``unit``."""
    sent = nodes.sparkSession.sparkContext.broadcast(centroids)

    def convert(batch: pa.RecordBatch) -> dict:
        points = np.array(batch["unit"].to_pylist()).reshape(len(batch), -1)
        near = min(overlap, len(sent.value))
        shards = [
            row.tolist()
            for block in blocks_of(points)
            for row in np.argpartition(squared(block, sent.value), near - 1, axis=1)[:, :near]
        ]
        return {"key": batch["key"], "unit": batch["unit"], "shards": pa.array(shards, pa.list_(pa.int64()))}

    found = per_batch(nodes.select("key", "unit"), convert, "key binary, unit array<double>, shards array<bigint>")
    return found.select("key", "unit", F.explode("shards").alias("shard"))


def in_parts(rows: DataFrame) -> DataFrame:
    """``rows`` of shards with ``part``: a large shard's vectors are dealt to sections, and each pair of sections is a part.

    So every two vectors of a shard meet in a part, and a part holds at most about twice
    ``PART`` vectors, however large the shard is.
    """
    sizes = rows.groupBy("shard").agg(F.ceil(F.count("*") / PART).cast("int").alias("sections"))
    rows = rows.join(stage(sizes, "sizes"), "shard")
    section = F.when(F.col("sections") > 1, F.pmod(F.xxhash64("key"), F.col("sections")).cast("int")).otherwise(0)
    other = F.explode(F.sequence(F.lit(0), F.col("sections") - 1))
    rows = rows.withColumn("section", section).withColumn("other", other)
    # A pair of different sections holds both, a section with itself is only needed where it is alone.
    rows = rows.filter((F.col("sections") == 1) | (F.col("section") != F.col("other")))
    part = F.least("section", "other") * F.col("sections") + F.greatest("section", "other")
    return rows.withColumn("part", part).drop("sections", "section", "other")


def built(parts: DataFrame) -> DataFrame:
    """Adjacency of every vector, united over the parts it is in: ``key``, ``near`` (keys)."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        points, keys = np.stack(rows["unit"].to_numpy()), rows["key"].to_numpy()
        pairs = edges_of(robust_pruned(points))
        return pd.DataFrame({"key": keys[pairs[:, 0]], "near": keys[pairs[:, 1]]})

    edges = parts.groupBy("shard", "part").applyInPandas(build, "key binary, near binary")
    return edges.groupBy("key").agg(F.collect_set("near").alias("near"))


def searched(parts: DataFrame, adjacency: DataFrame, cosine: float) -> DataFrame:
    """Pairs ``a`` < ``b`` of keys with at least ``cosine``, found in any part."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        points, keys = np.stack(rows["unit"].to_numpy()), rows["key"].to_numpy()
        place = {key: i for i, key in enumerate(keys)}
        pairs = [
            (i, place[n]) for i, near in enumerate(rows["near"]) if near is not None for n in near if n in place
        ]
        graph = FlatGraph(points, np.array(pairs, dtype=np.int64).reshape(-1, 2))
        first, second = [], []
        for block in blocks_of(np.arange(len(points)), 256):
            seen, _ = graph.search(points[block], BEAM, 2 * (1 - cosine + SLACK))
            of, found = np.nonzero(np.isfinite(seen) & (seen <= 2 * (1 - cosine) + 1e-9))
            close = np.einsum("ij,ij->i", points[block][of], points[found]) >= cosine
            of, found = block[of[close]], found[close]
            smaller = keys[of] < keys[found]
            first.append(keys[of[smaller]])
            second.append(keys[found[smaller]])
            first.append(keys[found[~smaller & (of != found)]])
            second.append(keys[of[~smaller & (of != found)]])
        out = pd.DataFrame({"a": np.concatenate(first), "b": np.concatenate(second)})
        return out.drop_duplicates()

    rows = parts.join(adjacency, "key", "left")
    return rows.groupBy("shard", "part").applyInPandas(search, "a binary, b binary").distinct()


def true_links(nodes: DataFrame, cosine: float, count: int) -> DataFrame:
    """Links of nodes chosen by a hash, by brute force over all nodes: ``a`` < ``b``.

    Further nodes are audited, twice as many each time, until ``MEASURED`` links were seen or
    all nodes are audited.
    """
    found, low, high = None, 0.0, min(1.0, AUDITED / max(1, count))
    while True:
        place = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
        # The nodes of a range in blocks of about MATRIX; every block is a matrix on its own.
        blocks = max(1, round(count * (high - low) / MATRIX))
        for block in range(blocks):
            begin, end = low + (high - low) * block / blocks, low + (high - low) * (block + 1) / blocks
            chosen = nodes.filter((place >= begin) & ((place < end) if end < 1 else F.lit(True)))
            more = links_of(nodes, chosen.select("key", "unit").collect(), cosine)
            if more is not None:
                found = more if found is None else found.union(more)
        if found is not None:
            found = stage(found.distinct(), "audit")
        if high >= 1 or (found is not None and found.count() >= MEASURED):
            return found
        low, high = high, min(1.0, 2 * high)


def links_of(nodes: DataFrame, chosen: list, cosine: float) -> DataFrame | None:
    """Links of a bounded list of nodes with all."""
    if not chosen:
        return None
    keys, points = [bytes(r["key"]) for r in chosen], np.array([r["unit"] for r in chosen])

    def convert(batch: pa.RecordBatch) -> dict:
        own = np.array(batch["unit"].to_pylist()).reshape(len(batch), -1)
        of, at = np.nonzero(own @ points.T >= cosine)
        names = batch["key"].to_pylist()
        pairs = {(min(names[i], keys[j]), max(names[i], keys[j])) for i, j in zip(of, at, strict=True) if names[i] != keys[j]}
        return {"a": pa.array([a for a, _ in pairs], pa.binary()), "b": pa.array([b for _, b in pairs], pa.binary())}

    return stage(per_batch(nodes.select("key", "unit"), convert, "a binary, b binary").distinct(), "audit")


def near_links(nodes: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> tuple[DataFrame, float]:
    """Links between distinct vectors and their audited recall; the overlap doubles until the recall suffices.

    Recall is only 1 without a true link if every node was audited.
    """
    count = nodes.count()
    true = true_links(nodes, cosine, count)
    total = true.count() if true is not None else 0
    points = sample(nodes.withColumnRenamed("unit", "vector"), count)
    shards = min(MOST_CENTROIDS, max(1, round(count / SHARD)))
    centroids = balanced_centroids(points, shards) if count else np.zeros((1, 1))
    overlap = OVERLAP
    while True:
        parts = stage(in_parts(members(nodes, centroids, overlap)), "parts")
        links = stage(searched(parts, stage(built(parts), "adjacency"), cosine), "links")
        share = true.join(links, ["a", "b"]).count() / total if total else 1.0
        if share >= recall or overlap >= len(centroids):
            return links, share
        overlap *= 2


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links and component of every row: ``vec_id``, ``n_links``, ``component_id``, ``kept``, ``recall``.

    ``n_links`` counts the other vec_ids linked directly, exact copies included, which are
    collapsed first and counted by number. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Rows that repeat an id and its vector are one
    vector and all come out; a null id takes part, its row is kept if its component has no
    other id. Vectors must have one length. ``recall`` is the audited share of links.
    """
    rows = stage(keyed(vectors), "vectors")
    nodes = stage(nodes_of(rows), "nodes")
    links, share = near_links(nodes, cosine)
    labels = components(links)
    sizes = nodes.select("key", "copies")
    both = links.union(links.select("b", "a"))
    linked = both.join(sizes.withColumnRenamed("key", "b"), "b").groupBy("a").agg(F.sum("copies").alias("linked"))
    named = nodes.join(labels.withColumnRenamed("node", "key"), "key", "left")
    named = stage(named.select("key", "vec_id", "copies", F.coalesce("label", "key").alias("label")), "named")
    heads = stage(named.groupBy("label").agg(F.min("vec_id").alias("component_id")), "heads")
    facts = (
        named.join(heads, "label")
        .join(linked.withColumnRenamed("a", "key"), "key", "left")
        .select("key", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    )
    of_rows = rows.select("vec_id", "key").distinct().join(stage(facts, "facts"), "key").drop("key")
    of_rows = of_rows.groupBy("vec_id").agg(F.min("component_id").alias("component_id"), F.max("n_links").alias("n_links"))
    found = vectors.select("vec_id").join(
        stage(of_rows, "rows").withColumnRenamed("vec_id", "id"), F.col("vec_id").eqNullSafe(F.col("id")), "left"
    )
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
        F.lit(share).alias("recall"),
    )


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
