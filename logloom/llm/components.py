"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut


def _star(links: DataFrame, both: DataFrame, least: DataFrame, larger: bool) -> Cut:
    """Each node of links (u > v) is linked to the least of its neighbours, or of its neighbours and itself."""
    # the least neighbours are written first: Spark splits a hub's rows only in a join of two plain shuffles
    smallest = Cut(least)
    moved = both.join(smallest.df, "u").where("v > u" if larger else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    rest = moved if larger else moved.unionByName(smallest.df.select("u", F.col("m").alias("v")))
    made = Cut(rest.distinct())
    smallest.drop()
    return made


def _round(links: DataFrame) -> Cut:
    """A large star, in which larger neighbours move to a node's least one, then a small star of smaller ones."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _star(links, both, both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), True)
    small = _star(large.df, large.df, large.df.groupBy("u").agg(F.min("v").alias("m")), False)
    large.drop()
    return small


def _state(links: DataFrame) -> tuple:
    """What tells one set of links from another: its size and the sum of its hashes."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, u: str = "u", v: str = "v") -> Cut:
    """node, component: every node that has a link, with the smallest node that it reaches.

    Each round is two aggregations, which combine a hub's links before they are shuffled, and two joins on
    the node of tables in the shared folder, in which Spark may split a hub's rows. Links with a null end
    and loops are ignored. The caller drops the table once it has read it.
    """
    found = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(f"{u} is not null and {v} is not null")
    now = Cut(found.where("u <> v").distinct())
    state = _state(now.df)
    while state[0]:
        after = _round(now.df)
        before, state = state, _state(after.df)
        now.drop()
        now = after
        if state == before:
            break
    roots = now.df.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    named = Cut(now.df.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots))
    now.drop()
    return named
