"""Connected components of an undirected graph, as a loop of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialized


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v); ``label`` is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then
    the label of that label's node (pointer jumping), so long chains need a
    logarithmic number of rounds. Every round is a written table: the lineage
    stays short, and a lost executor repeats tasks of one round only. The
    jump joins two plain tables, so AQE can split the label that a whole
    component shares. Repeated edges, loops and both directions may be given;
    an empty ``edges`` gives an empty result.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialized(both.distinct(), "edges")
    labels = materialized(
        both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("label")), "labels")
    while True:
        offered = both.join(labels, F.col("v") == F.col("node")).select(F.col("u").alias("node"), "label")
        hooked = materialized(
            offered.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")), "labels")
        target = hooked.select(F.col("node").alias("label"), F.col("label").alias("jumped"))
        jumped = materialized(hooked.join(target, "label").select("node", F.col("jumped").alias("label")), "labels")
        if labels.exceptAll(jumped).isEmpty():
            return jumped
        labels = jumped
