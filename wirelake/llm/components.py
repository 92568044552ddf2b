"""Connected components of a link table by union-find in rounds.

Each round hooks every node to the smallest node known in its neighbourhood
(large-star, small-star), which is the distributed form of union with path
compression: a component of diameter d is a star after O(log d) rounds. Every
round is an aggregation with partial results, so a hub is never gathered in one
task; each round is written, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.session import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hook the larger (or the smaller) neighbours of each node to its smallest one."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    hooked = both.join(low, "a")
    if large:
        return hooked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    return hooked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` to ``(id, class_id)``: one row per linked node, class_id its smallest member.

    NULL ends and self-links are ignored; an empty table gives an empty table.
    """
    cur = materialize(edges.select("a", "b").filter("a <> b").distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        last, cur = cur, materialize(_star(_star(cur, True), False), "cc")
        discard(last)
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    hooked = cur.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("class_id"))
    return hooked.union(hooked.select(F.col("class_id").alias("id"), "class_id")).distinct()
