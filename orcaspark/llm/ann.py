"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component that makes all lengths equal, so the greatest inner product
is the least distance. Balanced centroids are fitted on a bounded sample and searched
through an in-memory graph. A vector near the boundary is put in several lists. A query
reads the lists whose centroid is at most a ratio farther than the nearest one; the ratio
is calibrated so that audited queries find the wanted share of their true neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, table
from orcaspark.llm.vectors import MOST_CENTROIDS, FlatGraph, balanced_centroids, blocks_of, sample, squared, usable
from orcaspark.session import stage

#: Neighbours returned, and rows that are queries: every so many ids.
NEIGHBOURS, EVERY = 20, 20
#: Vectors of a list aimed at; lists of a vector at most, and how much farther they may be.
LIST, REPLICAS, CLOSURE = 128, 3, 1.15
#: Queries audited at most, and the share of true neighbours that the ratio is set for.
AUDITED, RECALL = 128, 0.97
#: Vectors and queries of one comparison; results merged at a time.
SHELF, QUERIES, MERGED = 2048, 2048, 256


@dataclass
class Index:
    """Centroids in their graph, and the scale that levels lengths."""

    graph: FlatGraph
    longest: float  # greatest squared length

    def level(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (vectors**2).sum(axis=1), 0))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def aim(self, queries: np.ndarray) -> np.ndarray:
        """Queries of equal length without the additional component."""
        scale = np.sqrt(self.longest / (queries**2).sum(axis=1))
        return np.concatenate([queries * scale[:, None], np.zeros((len(queries), 1))], axis=1)

    def lists_of(self, vectors: np.ndarray) -> list[list[int]]:
        """The list of the nearest centroid, and near ones that aren't nearer to a chosen centroid than to the vector."""
        points, centroids = self.level(vectors), self.graph.points
        found = []
        for block in blocks_of(points, 512):
            seen, ids = self.graph.search(block, min(16, len(centroids)))
            for row, near in zip(seen, ids, strict=True):
                chosen: list[int] = []
                for c in near.tolist():
                    if c < 0 or row[c] > CLOSURE**2 * row[near[0]] or len(chosen) == REPLICAS:
                        break
                    if all(((centroids[c] - centroids[k]) ** 2).sum() > row[c] for k in chosen):
                        chosen.append(c)
                found.append(chosen)
        return found

    def probes(self, queries: np.ndarray, ratio: float, sizes: np.ndarray, least: int) -> list[list[int]]:
        """Lists whose centroid is at most ``ratio`` times as far as the nearest; searched through the graph.

        Where they hold fewer than ``least`` of the ids that ``sizes`` counts, the next nearest lists are added.
        """
        found = []
        for block in blocks_of(self.aim(queries), 256):
            beam = min(16, len(self.graph.points))
            seen, ids = self.graph.search(block, beam)
            limit = ratio**2 * seen[np.arange(len(block)), ids[:, 0]] + 1e-12
            seen, _ = self.graph.search(block, beam, limit[:, None])
            for query, near in zip(block, seen <= limit[:, None], strict=True):
                if sizes[near].sum() < least:
                    order = squared(query[None], self.graph.points)[0].argsort(kind="stable")
                    enough = int(np.searchsorted(np.cumsum(sizes[order]), least)) + 1
                    near[order[:enough]] = True
                found.append(np.flatnonzero(near).tolist())
        return found


def build(vectors: DataFrame) -> Index:
    """Index of a staged table of ``vec_id``, ``vector``; fitted on about ``SAMPLE`` of its rows."""
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    count, longest = vectors.agg(F.count("*"), F.max(squares)).first()
    fitted = Index(None, longest)
    points = fitted.level(sample(vectors, count))
    lists = min(MOST_CENTROIDS, max(1, round(count / LIST)))
    fitted.graph = FlatGraph(balanced_centroids(points, lists))
    return fitted


def posted(vectors: DataFrame, index: Index) -> DataFrame:
    """Every vector in its lists: ``vec_id``, ``vector``, ``lists``."""
    sent = vectors.sparkSession.sparkContext.broadcast(index)

    def convert(batch: pa.RecordBatch) -> dict:
        points = np.array(batch["vector"].to_pylist()).reshape(len(batch), -1)
        lists = sent.value.lists_of(points) if len(batch) else []
        return {"vec_id": batch["vec_id"], "vector": batch["vector"], "lists": pa.array(lists, pa.list_(pa.int64()))}

    return per_batch(vectors, convert, "vec_id bigint, vector array<double>, lists array<bigint>")


def true_neighbours(vectors: DataFrame, queries: list[tuple[int, list[float]]], count: int) -> DataFrame:
    """Brute force for a bounded list of queries: ``query_id``, ``vec_id``, ``score``, ``rank``."""
    ids, points = np.array([q for q, _ in queries]), np.array([v for _, v in queries])

    def convert(batch: pa.RecordBatch) -> dict:
        own, names = np.array(batch["vector"].to_pylist()).reshape(len(batch), -1), np.array(batch["vec_id"].to_pylist())
        best = [best_ids(p, i, own, names, count) for p, i in zip(points, ids, strict=True)] if len(batch) else []
        return {
            "query_id": pa.array(np.repeat(ids[: len(best)], [len(n) for n, _ in best]), pa.int64()),
            "vec_id": pa.array(np.concatenate([n for n, _ in best]) if best else [], pa.int64()),
            "score": pa.array(np.concatenate([s for _, s in best]) if best else [], pa.float64()),
        }

    found = per_batch(
        vectors.select("vec_id", "vector"), convert, "query_id bigint, vec_id bigint, score double", rows=1 << 20
    )
    return ranked(merged(found.groupBy("query_id").agg(F.collect_list(_pair()).alias("found")), "query_id", count=count))


def best_of(query: np.ndarray, query_id: int, points: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``count`` best others: greatest product first, then smallest id.

    Products for the choice come from one matrix-vector product; all within rounding of
    the last place are summed again in one fixed order, so that equal vectors tie exactly.
    """
    rough = points @ query
    rough[ids == query_id] = -np.inf
    size = min(count, len(ids))
    last = np.partition(rough, len(ids) - size)[len(ids) - size] if size else 0.0
    tolerance = 1e-9 * max(1.0, float(np.abs(rough[np.isfinite(rough)]).max(initial=0.0)))
    close = np.flatnonzero((rough >= last - tolerance) & np.isfinite(rough))
    scores = (points[close] * query).sum(axis=1)
    order = np.lexsort((ids[close], -scores))[:size]
    return ids[close][order], scores[order]


def best_ids(query: np.ndarray, query_id: int, points: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``best_of``, for the ``count`` best distinct ids, each with its best score; repeated rows take no place."""
    wanted = count
    while True:
        names, scores = best_of(query, query_id, points, ids, wanted)
        first = np.sort(np.unique(names, return_index=True)[1])[:count]  # rows are sorted, so the first is the best
        if len(first) == count or wanted >= len(ids):
            return names[first], scores[first]
        wanted *= 4


def _pair():
    """Order of results as a struct: best first when sorted."""
    return F.struct((-F.col("score")).alias("minus"), F.col("vec_id").alias("vec_id"))


def merged(found: DataFrame, *keys: str, count: int) -> DataFrame:
    """``found`` cut to its ``count`` best entries of distinct ids, per row; an id has its best score."""

    def add(kept, x):
        known = F.exists(kept, lambda y: y["vec_id"] == x["vec_id"])
        return F.when((F.size(kept) >= count) | known, kept).otherwise(F.array_append(kept, x))

    ordered = found.select(*keys, F.array_sort("found").alias("found"))
    return ordered.select(*keys, F.aggregate("found", F.slice("found", 1, 0), add).alias("found"))


def ranked(found: DataFrame) -> DataFrame:
    """One row per result, ranked from 1."""
    rows = found.select("query_id", F.posexplode("found").alias("place", "result"))
    return rows.select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("result.vec_id").alias("vec_id"),
        (-F.col("result.minus")).alias("score"),
    )


def calibrated(postings: DataFrame, queries: DataFrame, index: Index, recall: float) -> float:
    """Least ratio at which the lists read hold ``recall`` of the audited queries' true neighbours."""
    count = queries.count()
    place = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30))
    chance = min(1.0, AUDITED / max(1, count))
    audited = queries.filter(place < int(chance * (1 << 30)) if chance < 1 else F.lit(True)).collect()
    if not audited:
        return 1.0
    vectors = {r["vec_id"]: np.array(r["vector"]) for r in audited}
    true = stage(true_neighbours(postings, [(i, v) for i, v in vectors.items()], NEIGHBOURS), "true")
    places = true.join(postings.select("vec_id", "lists"), "vec_id").select("query_id", "lists").collect()
    if not places:
        return 1.0
    centroids, needed = index.graph.points, []
    distances = {i: np.sqrt(squared(index.aim(v[None]), centroids)[0]) for i, v in vectors.items()}
    for r in places:
        own = distances[r["query_id"]]
        needed.append(own[r["lists"]].min() / max(own.min(), 1e-12))
    needed.sort()
    return float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) * (1 + 1e-9)


def search(vectors: DataFrame, neighbours: int = NEIGHBOURS, every: int = EVERY, recall: float = RECALL) -> DataFrame:
    """Nearest ``neighbours`` of the rows whose vec_id is divisible by ``every``, among all others.

    Returns ``query_id``, ``rank``, ``vec_id``, ``score``: greatest inner product first, ties
    to the smaller id; fewer rows where there are fewer candidates. Vectors that are null,
    empty, zero or hold null or non-finite components take no part, nor do rows without an id.
    Rows sharing a query's id are its own and no candidates; a candidate's id comes once,
    with its best score. Vectors must have one length. Lists and the queries that read
    them are compared in bounded shelves, so a hot list is spread over many tasks.
    """
    points = stage(usable(vectors.filter("vec_id is not null")), "vectors")
    if points.isEmpty():
        return points.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    is_query = F.col("vec_id") % every == 0
    index = build(points)
    postings = stage(posted(points, index), "postings")
    queries = postings.filter(is_query).select("vec_id", "vector")
    ratio = calibrated(postings, queries, index, recall)
    # Shelves: stretches of lists with about SHELF vectors; a longer list has several sections.
    per_list = postings.select(F.explode("lists").alias("list")).groupBy("list").count()
    sizes = np.zeros(len(index.graph.points), dtype=np.int64)
    for r in per_list.collect():  # one row per centroid
        sizes[r["list"]] = r["count"]
    sections = np.maximum(-(-sizes // SHELF), 1)
    spread = sizes // sections
    shelf_of = (np.cumsum(spread) - spread) // SHELF
    # Every id counts in one of its lists only, so these are enough other ids.
    least, homes = neighbours + 1, np.zeros_like(sizes)
    home = postings.groupBy("vec_id").agg(F.min(F.get("lists", F.lit(0))).alias("home"))
    for r in home.groupBy("home").count().collect():  # one row per centroid
        homes[r["home"]] = r["count"]
    sent = points.sparkSession.sparkContext.broadcast((index, ratio, shelf_of, sections, homes))

    def probe(batch: pa.RecordBatch) -> dict:
        known, limit, shelves, parts, filled = sent.value
        own = np.array(batch["vector"].to_pylist()).reshape(len(batch), -1)
        rows, keys, lists = [], [], []
        for i, probes in enumerate(known.probes(own, limit, filled, least) if len(batch) else []):
            by_shelf: dict[tuple[int, int], list[int]] = {}
            for c in probes:
                for section in range(parts[c]):
                    by_shelf.setdefault((int(shelves[c]), section), []).append(c)
            rows += [i] * len(by_shelf)
            keys += by_shelf
            lists += by_shelf.values()
        chosen = pa.array(rows, pa.int64())
        return {
            "query_id": batch["vec_id"].take(chosen),
            "query": batch["vector"].take(chosen),
            "shelf": pa.array([k[0] for k in keys], pa.int64()),
            "section": pa.array([k[1] for k in keys], pa.int64()),
            "wanted": pa.array(lists, pa.list_(pa.int64())),
        }

    asked = stage(
        per_batch(queries, probe, "query_id bigint, query array<double>, shelf bigint, section bigint, wanted array<bigint>"),
        "asked",
    )
    askers = asked.groupBy("shelf", "section").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    askers = stage(askers, "askers")
    asked = asked.join(askers, ["shelf", "section"]).select(
        "query_id", "query", "wanted", "shelf", "section", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block")
    )

    def place(batch: pa.RecordBatch) -> dict:
        _, _, shelves, parts, _ = sent.value
        rows, lists, sections_ = [], [], []
        for i, (name, own) in enumerate(zip(batch["vec_id"].to_pylist(), batch["lists"].to_pylist(), strict=True)):
            for c in own:
                rows.append(i)
                lists.append(c)
                sections_.append(name * 0x9E3779B97F4A7C15 % (1 << 64) * int(parts[c]) >> 64)
        chosen = pa.array(rows, pa.int64())
        return {
            "vec_id": batch["vec_id"].take(chosen),
            "vector": batch["vector"].take(chosen),
            "list": pa.array(lists, pa.int64()),
            "shelf": pa.array([int(shelves[c]) for c in lists], pa.int64()),
            "section": pa.array(sections_, pa.int64()),
        }

    shelved = per_batch(postings, place, "vec_id bigint, vector array<double>, list bigint, shelf bigint, section bigint")
    by_block = askers.select(
        F.col("shelf").alias("its_shelf"), F.col("section").alias("its_section"), F.sequence(F.lit(0), F.col("blocks") - 1).alias("its_blocks")
    )
    shelved = shelved.join(
        by_block, (F.col("shelf") == F.col("its_shelf")) & (F.col("section") == F.col("its_section"))
    ).select("vec_id", "vector", "list", "shelf", "section", F.explode("its_blocks").alias("block"))

    def compare(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if own.empty or others.empty:
            return pd.DataFrame({"query_id": [], "shelf": [], "found": []})
        stack, ids, lists = np.stack(others["vector"].to_numpy()), others["vec_id"].to_numpy(), others["list"].to_numpy()
        rows = {}
        for c in np.unique(lists):
            rows[c] = np.flatnonzero(lists == c)
        found = []
        for name, vector, wanted in zip(own["query_id"], own["query"], own["wanted"], strict=True):
            read = [rows[c] for c in wanted if c in rows]
            part = np.unique(np.concatenate(read)) if read else np.zeros(0, dtype=np.int64)
            names, scores = best_ids(np.asarray(vector), name, stack[part], ids[part], neighbours)
            found.append([{"minus": -s, "vec_id": n} for n, s in zip(names.tolist(), scores.tolist(), strict=True)])
        return pd.DataFrame({"query_id": own["query_id"], "shelf": own["shelf"], "found": found})

    keys = ["shelf", "section", "block"]
    schema = "query_id bigint, shelf bigint, found array<struct<minus: double, vec_id: bigint>>"
    found = asked.groupBy(*keys).cogroup(shelved.groupBy(*keys)).applyInPandas(compare, schema)
    for group in (F.floor(F.col("shelf") / MERGED), F.lit(0)):
        found = found.groupBy("query_id", group.alias("shelf")).agg(F.flatten(F.collect_list("found")).alias("found"))
        found = merged(found, "query_id", "shelf", count=neighbours)
    return ranked(found).withColumn("rank", F.col("rank").cast("int"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest embeddings of every twentieth id."""
    return search(table(spark, sf_dir, "embeddings"))
