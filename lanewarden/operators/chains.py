"""Following successor links from sure beginnings, without one task per history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewarden.session import materialize


def follow(nodes: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The rows of ``nodes`` that are reached from those with ``_sure`` by any number of ``_next`` links.

    ``at`` places a row among those with its ``keys``; ``_next`` is the place of its successor, or null.
    Links are doubled from round to round (1, 2, 4, ... successors), each round a join of stored tables, so
    a chain of any length takes a logarithmic number of rounds. Returns ``nodes`` without the two columns.
    """
    nodes = materialize(nodes, "chain-nodes")
    place = [*keys, at]
    jumps = nodes.where("_next is not null").select(*place, "_next")
    reached, known = nodes.where("_sure").select(*place), -1
    while (found := reached.count()) != known:
        known = found
        further = reached.join(jumps, place).select(*keys, F.col("_next").alias(at))
        reached = materialize(reached.unionByName(further).distinct(), "chain-reached")
        second = jumps.select(*keys, F.col(at).alias("_next"), F.col("_next").alias("_after"))
        doubled = jumps.join(second, [*keys, "_next"]).select(*place, F.col("_after").alias("_next"))
        jumps = materialize(doubled, "chain-jumps")
    return nodes.join(reached, place).drop("_sure", "_next")
