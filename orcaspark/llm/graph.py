"""Connected components of an edge table by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.session import stage, unstage


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (``a``, ``b``; any ordered type): ``node``, ``label``.

    Each round hands every node the least label of its neighbours, then replaces a label by
    its own label, which halves chains; rounds end when no label changes. Labels are
    summed up per node before they are shuffled, and a node with many edges is only a hot
    key of a join, which is split. Each round is a written table, so lineage stays short
    and a lost executor costs a re-read.
    """
    edges = edges.select("a", "b")
    both = stage(edges.union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
                   .select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        offered = (
            both.join(labels.select(F.col("node").alias("a"), "label"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("offer"))
        )
        better = stage(labels.select("node", "label").join(offered, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "offer").alias("label")), "labels")
        jump = better.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stage(better.join(jump, "label").select("node", "old", F.col("further").alias("label")), "labels")
        moved = not new.filter("old <> label").isEmpty()
        if not moved:
            unstage(both, better, new)
            return labels.select("node", "label")
        unstage(labels, better)
        labels = new
