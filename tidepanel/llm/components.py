"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import HOT_ROWS, hot_limit, join_one
from tidepanel.sources.staging import stage


def _with_least(around: DataFrame, limit: int) -> DataFrame:
    """Each row (u, v) with the least of u and all its v; the least is found map-side first.

    A node with more than ``limit`` rows is looked up where these are.
    """
    least = around.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return join_one(around, least.select("u", F.least("u", "m").alias("m"), "n"), "u", limit)


def large_star(edges: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    around = edges.union(edges.select("v", "u"))
    linked = _with_least(around, limit).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def small_star(edges: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges have v < u."""
    linked = _with_least(edges, limit)
    both = linked.select("v", "m").union(linked.select("u", "m")).toDF("u", "v")
    return both.filter("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge, component being the least node it reaches.

    ``edges`` has two integer columns; loops and rows with a null are ignored, rows may repeat and
    point either way. No edges: no rows. Each round is written to the staging folder, so a lost
    executor costs tasks of one round.
    """
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = stage(now.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        # Twice the edges lie around their nodes.
        limit = hot_limit(2 * seen[0])
        now = stage(small_star(stage(large_star(now, limit), "stars"), limit), "edges")
        found = _print(now)
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.union(roots).toDF("node", "component")
