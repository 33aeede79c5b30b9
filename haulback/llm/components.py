"""Connected components of a graph given by its edges."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.operators.lineage import cut_lineage


def connected_components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """Rows (node, component): each node of an edge (a, b), and the least node it is connected with.

    Large and small stars in turn: every node hands its neighbours on to the least node it knows,
    until all edges of a component meet in its least node. Minima are aggregated before they are
    sent, and the joins back to the edges split a node of very many edges. ``folder`` takes the
    tables between the rounds.
    """
    keep = partial(cut_lineage, folder=folder)
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = keep(edges.distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = keep(large.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = keep(moved.unionByName(least.withColumnRenamed("m", "b")).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
