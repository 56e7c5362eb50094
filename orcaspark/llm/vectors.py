"""Vector helpers in numpy: balanced centroids and a robust-pruned flat graph with greedy search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch

#: Vectors that centroids are fitted on: about so many, chosen by a hash of their id.
SAMPLE = 20_000
#: Most centroids; they are kept in memory by every task (64 dimensions: 2 MB).
MOST_CENTROIDS = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """Rows of ``vec_id``, ``embedding`` whose vector takes part, as ``vec_id``, ``vector`` (doubles).

    Null, empty and zero vectors and those with null or non-finite components are left out.
    """

    def convert(batch: pa.RecordBatch) -> dict:
        rows, places = [], []
        for place, vector in enumerate(batch["embedding"].to_pylist()):
            if vector and None not in vector:
                row = np.asarray(vector, dtype=np.float64)
                if np.isfinite(row).all() and row.any():
                    rows.append(row)
                    places.append(place)
        return {
            "vec_id": batch["vec_id"].take(pa.array(places, pa.int64())),
            "vector": pa.array(rows, pa.list_(pa.float64())),
        }

    return per_batch(vectors.select("vec_id", "embedding"), convert, "vec_id bigint, vector array<double>")


def sample(vectors: DataFrame, count: int, size: int = SAMPLE) -> np.ndarray:
    """About ``size`` of ``count`` rows of ``vec_id``, ``vector`` as a matrix, chosen and ordered by a hash."""
    chance = min(1.0, size / max(1, count))
    place = F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(1 << 30))
    rows = vectors.filter(place < int(chance * (1 << 30)) if chance < 1 else F.lit(True))
    found = rows.select(place.alias("place"), "vec_id", "vector").collect()
    return np.array([r["vector"] for r in sorted(found, key=lambda r: (r["place"], str(r["vec_id"]), r["vector"]))])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``."""
    return np.maximum((a**2).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b**2).sum(axis=1)[None, :], 0)


def balanced_centroids(points: np.ndarray, count: int, seed: int = 4) -> np.ndarray:
    """About ``count`` centroids of parts of equal size.

    The points are halved again and again at the median along the line between the means
    of two halves, so a dense region gets as many centroids as it has points; two rounds
    of reassignment then settle the centroids.
    """
    rng = np.random.default_rng(seed)
    parts = [np.arange(len(points))]
    while len(parts) < count:
        halves = []
        for part in parts:
            if len(part) < 2:
                halves.append(part)
                continue
            own = points[part]
            a, b = own[rng.choice(len(part), 2, replace=False)]
            for _ in range(4):
                along = own @ (a - b)
                upper = along > np.median(along)
                if not upper.any() or upper.all():
                    break
                a, b = own[upper].mean(axis=0), own[~upper].mean(axis=0)
            order = np.argsort(own @ (a - b), kind="stable")
            halves += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
        if len(halves) == len(parts):
            break
        parts = halves
    centroids = np.array([points[part].mean(axis=0) for part in parts])
    for _ in range(2):
        nearest = np.concatenate([squared(block, centroids).argmin(axis=1) for block in blocks_of(points)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def blocks_of(rows: np.ndarray, size: int = 1024) -> Iterator[np.ndarray]:
    for begin in range(0, len(rows), size):
        yield rows[begin : begin + size]


# -- Flat graph --------------------------------------------------------------------------

#: Neighbours a point keeps, candidates they are chosen from, and how much nearer to a kept
#: neighbour than to the point (in squared distance) a candidate must be to be dropped.
DEGREE, CANDIDATES, ALPHA = 16, 48, 1.2


def robust_pruned(points: np.ndarray, degree: int = DEGREE, seed: int = 7) -> np.ndarray:
    """Neighbours of each point by robust pruning, rows filled up with -1.

    Candidates are a point's nearest others and some random ones. The nearest is kept, and
    candidates much nearer to it than to the point are dropped, until none is left.
    """
    size = len(points)
    rng = np.random.default_rng(seed)
    near = min(CANDIDATES, size - 1)
    lists = np.full((size, degree), -1, dtype=np.int64)
    for begin in range(0, size, 256):
        block = np.arange(begin, min(begin + 256, size))
        distance = squared(points[block], points)
        distance[np.arange(len(block)), block] = np.inf
        if near <= 0:
            continue
        nearest = np.argpartition(distance, near - 1, axis=1)[:, :near]
        ids = np.concatenate([nearest, rng.integers(0, size, (len(block), 8))], axis=1)
        own = np.take_along_axis(distance, ids, axis=1)  # a point itself is infinitely far
        order = np.argsort(own, axis=1, kind="stable")
        ids, own = np.take_along_axis(ids, order, axis=1), np.take_along_axis(own, order, axis=1)
        vectors = points[ids]
        alive = np.isfinite(own)
        rows = np.arange(len(block))
        for slot in range(degree):
            first = alive.argmax(axis=1)
            has = alive[rows, first]
            if not has.any():
                break
            lists[block[has], slot] = ids[rows, first][has]
            between = ((vectors - vectors[rows, first][:, None, :]) ** 2).sum(axis=2)
            alive &= (ALPHA * between > own) & (ids != ids[rows, first][:, None])
            alive[~has] = False
    return lists


def medoid(points: np.ndarray) -> int:
    """The point nearest to the mean."""
    return int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())


class FlatGraph:
    """Points with adjacency lists in both directions; every point can be reached from the medoid."""

    def __init__(self, points: np.ndarray, pairs: np.ndarray | None = None):
        """``pairs`` are edges (rows of two positions); by default those of robust pruning."""
        self.points = points
        self.start = medoid(points)
        if pairs is None:
            pairs = edges_of(robust_pruned(points))
        pairs = np.concatenate([pairs, pairs[:, ::-1]]).reshape(-1, 2)
        pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        self._fill(np.concatenate([pairs, self._bridges(pairs)]).reshape(-1, 2))

    def _fill(self, pairs: np.ndarray) -> None:
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        self.degrees = np.bincount(pairs[:, 0], minlength=len(self.points))
        self.begins = np.cumsum(self.degrees) - self.degrees
        self.neighbours = pairs[:, 1]

    def _bridges(self, pairs: np.ndarray) -> np.ndarray:
        """Edges from reached points to the nearest points of parts that can't be reached."""
        group = np.arange(len(self.points))
        while len(pairs):  # label propagation; edges run in both directions
            new = group.copy()
            np.minimum.at(new, pairs[:, 0], group[pairs[:, 1]])
            new = new[new]
            if (new == group).all():
                break
            group = new
        added = []
        for part in np.unique(group):
            if part != group[self.start]:
                inside, others = np.flatnonzero(group == part), np.flatnonzero(group != part)
                head = inside[medoid(self.points[inside])]
                other = others[squared(self.points[head][None], self.points[others])[0].argmin()]
                added += [(head, other), (other, head), (self.start, head), (head, self.start)]
        return np.array(added, dtype=np.int64).reshape(-1, 2)

    def search(
        self, queries: np.ndarray, beam: int, radius: float | np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Greedy search from the medoid for all queries at once, by squared distance.

        Expands the nearest unexpanded points among the ``beam`` nearest seen, several at a
        time, until all are expanded. With ``radius`` it then goes on from every point seen
        within that squared distance, until no unexpanded one is left. Returns the squared
        distances of all points, infinite where not seen, and the ids of the beam.
        """
        count, size = len(queries), len(self.points)
        seen = np.full((count, size), np.inf)
        mark = np.zeros((count, size), dtype=np.int64)
        expanded = np.zeros((count, size), dtype=bool)
        rows = np.arange(count)
        begin = ((queries - self.points[self.start]) ** 2).sum(axis=1)
        seen[:, self.start] = begin
        ids = np.full((count, beam), -1, dtype=np.int64)
        values = np.full((count, beam), np.inf)
        ids[:, 0], values[:, 0] = self.start, begin

        def visit(of: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Distances of the unseen neighbours of ``nodes``, each met by its query ``of``."""
            expanded[of, nodes] = True
            degrees = self.degrees[nodes]
            of = np.repeat(of, degrees)
            within = np.arange(len(of)) - np.repeat(np.cumsum(degrees) - degrees, degrees)
            near = self.neighbours[np.repeat(self.begins[nodes], degrees) + within]
            new = np.isinf(seen[of, near])
            of, near = of[new], near[new]
            turn = np.arange(len(of))
            mark[of, near] = turn
            once = mark[of, near] == turn
            of, near = of[once], near[once]
            distance = np.empty(len(of))
            for part in blocks_of(np.arange(len(of)), 8192):
                distance[part] = ((queries[of[part]] - self.points[near[part]]) ** 2).sum(axis=1)
            seen[of, near] = distance
            return of, near, distance

        while True:
            open_ = np.isfinite(values) & ~expanded[rows[:, None], ids]
            chosen = np.where(open_, values, np.inf)
            some = min(4, beam)
            best = np.argpartition(chosen, some - 1, axis=1)[:, :some]
            wanted = np.isfinite(np.take_along_axis(chosen, best, axis=1))
            if not wanted.any():
                break
            of, near, distance = visit(np.repeat(rows, some)[wanted.ravel()], np.take_along_axis(ids, best, axis=1)[wanted])
            if len(of):
                order = np.argsort(of, kind="stable")
                of, near, distance = of[order], near[order], distance[order]
                sizes = np.bincount(of, minlength=count)
                column = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                more_ids = np.full((count, sizes.max()), -1, dtype=np.int64)
                more = np.full((count, sizes.max()), np.inf)
                more_ids[of, column], more[of, column] = near, distance
                ids, values = np.concatenate([ids, more_ids], axis=1), np.concatenate([values, more], axis=1)
                kept = np.argpartition(values, beam - 1, axis=1)[:, :beam]
                ids, values = np.take_along_axis(ids, kept, axis=1), np.take_along_axis(values, kept, axis=1)
        while radius is not None:
            of, nodes = np.nonzero((seen <= radius) & ~expanded)
            if not len(of):
                break
            for part in blocks_of(np.arange(len(of)), 4096):
                visit(of[part], nodes[part])
        order = np.argsort(values, axis=1, kind="stable")
        return seen, np.take_along_axis(ids, order, axis=1)


def edges_of(lists: np.ndarray) -> np.ndarray:
    """Adjacency lists, filled up with -1, as pairs of positions."""
    of, slot = np.nonzero(lists >= 0)
    return np.stack([of, lists[of, slot]], axis=1) if len(of) else np.zeros((0, 2), dtype=np.int64)
