"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage


def _stars(edges: DataFrame, low: DataFrame) -> DataFrame:
    return edges.join(low, "u")


def _large(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang each node's larger neighbours on its smallest neighbour."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stage(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), "large")
    out = _stars(both, low).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return stage(out.distinct(), "edges"), low


def _small(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang each node and its smaller neighbours on the smallest of them; edges go from larger to smaller."""
    low = stage(edges.groupBy("u").agg(F.min("v").alias("low")), "small")
    out = low.select("u", F.col("low").alias("v")).unionAll(
        _stars(edges, low).filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    )
    return stage(out.distinct(), "edges"), low


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for each node of the edges (u, v): root is the smallest node that can be reached.

    Alternates the two star operations until nothing changes: rounds grow with the logarithm of the longest
    path, each round is a minimum by node (combined map-side) and a join that adaptive execution splits for
    hubs, and each result is a table in the shared folder. Self-loops and repeated edges are fine; a node whose
    only edges are self-loops is left out.
    """
    now = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges"
    )
    mark = _mark(now)
    while mark[0]:
        large, low_a = _large(now)
        small, low_b = _small(large)
        for t in (now, low_a, large, low_b):
            discard(t)
        now, before = small, mark
        mark = _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct()
    return now.select("u", F.col("v").alias("root")).unionAll(roots)
