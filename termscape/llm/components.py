"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscape.session import Scratch, frozen


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest vertex around it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them. ``u`` is the larger end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    around = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return around.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``(u, v)`` links to ``(vertex, component)``: the smallest vertex reachable. Vertices without links are absent.

    Links only move towards smaller vertices, so the rows never exceed the links; each step is
    a table in the shared folder, and the ones before it are deleted. Null ends and loops are ignored.
    """
    spark = links.sparkSession
    edges = links.where("u is not null and v is not null and u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    with Scratch(spark) as scratch:
        edges = scratch.table(edges, "links")
        before = _mark(edges)
        while before[0]:
            edges = scratch.table(_small_star(_large_star(edges)), "links")
            scratch.drop_last(keep=1)
            after = _mark(edges)
            if after == before:
                break
            before = after
        vertices = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
        return frozen(vertices.union(roots), "components")
