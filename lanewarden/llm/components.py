"""Connected components of an edge table by alternating large-star and small-star steps.

Each step gives every node of a neighbourhood to its smallest member: the large star to those above
the centre, the small star to those below. Minima come from a map-side combined aggregate and one
join by the centre, so a centre with very many neighbours is never one group. Steps alternate until
the edges no longer change; each round is a stored table, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewarden.session import materialize


def _pointed(edges: DataFrame) -> DataFrame:
    """Edges from the larger end ``u`` to the smaller ``v``, once each, without loops."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple[int, int | None]:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``: the smallest node it is connected to.

    Ends are whole numbers; loops count as nodes; rows with a null end say nothing; repeated rows
    count once; no edges give no rows.
    """
    given = materialize(edges.select("u", "v").where("u is not null and v is not null"), "edges")
    now = materialize(_pointed(given), "star")
    state = _state(now)
    while state[0]:
        now = materialize(_pointed(_small_star(_pointed(_large_star(now)))), "star")
        before, state = state, _state(now)
        if state == before:
            break
    nodes = given.select(F.col("u").alias("node")).unionByName(given.select(F.col("v").alias("node"))).distinct()
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
