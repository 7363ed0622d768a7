"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, moves every link closer to its component's smallest id,
and keeps no more rows than there are links. Links are stored between steps, so lost executors
cost one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import stored

MAX_STEPS = 60


def _smallest(links: DataFrame) -> DataFrame:
    """u and m, the smallest id of u and its partners."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(stars: DataFrame) -> DataFrame:
    """Every id's larger partners, linked with the smallest id around it instead."""
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.filter("v > u").join(_smallest(both), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    """Every id, and its smaller partners, linked with the smallest of them."""
    smallest = _smallest(links)
    moved = links.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (moved.unionByName(smallest.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """id and component of every id in links (a, b); a component is named by its smallest id.

    Nulls link nothing. An empty table gives no rows; a link of an id to itself gives that id.
    """
    links = links.select("a", "b").filter("a is not null and b is not null")
    alone = links.filter("a = b").select(F.col("a").alias("id"))
    stars = stored(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(MAX_STEPS):
        state = stars.agg(F.count("*").alias("n"), F.sum(
            F.shiftright(F.xxhash64("u", "v"), 16)).alias("h")).first()
        if state == seen:
            break
        seen = state
        stars = stored(_small_star(_large_star(stars)))
    else:
        raise RuntimeError(f"links did not settle in {MAX_STEPS} steps")
    found = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return (found.unionByName(roots)
            .unionByName(alone.select("id", F.col("id").alias("component")))
            .groupBy("id").agg(F.min("component").alias("component")))
