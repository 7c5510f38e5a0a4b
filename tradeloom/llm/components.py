"""Connected components of a link table by alternating star contraction.

Every round replaces links by links to smaller neighbours. Two kinds of round
alternate: one moves each node's larger neighbours to its smallest neighbour,
the other its smaller ones. The links end as stars around the smallest node
of each component after a number of rounds that grows with the logarithm of
the component size, chains included. Each round is a written table, so a lost
executor costs one round at most, and only two numbers reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage


def _nearest(pairs: DataFrame) -> DataFrame:
    """Smallest of a node and its neighbours, written so that a hot node's
    join below has two shuffled sides that adaptive execution can split."""
    return stage(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "nearest")


def _larger_to_nearest(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    joined = both.join(_nearest(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _smaller_to_nearest(links: DataFrame) -> DataFrame:
    near = _nearest(links)
    moved = links.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = near.select("u", F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF))
    ).first()
    return row[0], row[1] or 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` of every node that has a link to another node.

    ``label`` is the smallest node of the component. Links may come in either
    direction and more than once; a link of a node to itself or with a NULL
    end says nothing and is ignored. No links give no rows.
    """
    u = F.greatest(F.col(a), F.col(b))
    v = F.least(F.col(a), F.col(b))
    # greatest and least skip NULLs, so a NULL end becomes a link to itself
    links = stage(links.select(u.alias("u"), v.alias("v")).where("u > v").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = stage(_larger_to_nearest(links), "stars")
        links = stage(_smaller_to_nearest(links), "stars")
        before, state = state, _state(links)
        if state == before:
            break
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(stars.select(F.col("label").alias("node"), "label").distinct())
