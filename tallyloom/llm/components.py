"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.sinks.scratch import materialize

#: Into so many pieces the neighbours of a node are dealt, so that a hub is no single task's.
PIECES = 64


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One round: the neighbours of every node are tied to its smallest one.

    ``edges`` have a > b. The large round ties the larger neighbours, the small one the
    smaller neighbours and the node itself. A node's neighbours are dealt into pieces, each with its own
    least; the least of all pieces goes back to those pieces that the node has, which are as
    many as it has neighbours or ``PIECES``. No node's neighbours are ever collected.
    """
    if larger:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    near = near.withColumn("piece", F.pmod(F.xxhash64("v"), F.lit(PIECES)).cast("int"))
    by_piece = near.groupBy("u", "piece").agg(F.min("v").alias("least"))
    least = by_piece.groupBy("u").agg(
        F.least(F.min("least"), F.col("u")).alias("least"), F.collect_set("piece").alias("pieces")
    )
    tied = near.join(least.select("u", "least", F.explode("pieces").alias("piece")), ["u", "piece"])
    if larger:
        tied = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("least").alias("b"))
    else:
        tied = tied.select(F.col("v").alias("a"), F.col("least").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("least").alias("b"))
        )
    return tied.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Edges may repeat, go either way or lead back to their own node. Alternates rounds of
    large and small stars until nothing changes; the number of rounds grows with the
    logarithm of the graph. Every round is written to the shared folder.
    """
    edges = (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = materialize(edges, "edges")
    seen = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        state = materialize(_stars(_stars(state, larger=True), larger=False), "edges")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
