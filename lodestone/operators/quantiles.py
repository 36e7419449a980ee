"""Exact quantiles and row numbers without a task that has all rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.catalog import stage


def exact_quantiles(values: DataFrame, value: str, points: Sequence[float], by: Sequence[str] = (), name: str = "quantiles") -> DataFrame:
    """(by, ``name``): for each group the quantiles at ``points`` by linear interpolation, as an array in their order.

    Null values don't count; groups without values are left out.
    """
    counts = values.groupBy(*by, F.col(value).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("_count"))
    return quantiles_of_counts(counts, "_value", "_count", points, by, name)


def quantiles_of_counts(table: DataFrame, value: str, count: str, points: Sequence[float], by: Sequence[str] = (), name: str = "quantiles") -> DataFrame:
    """As :func:`exact_quantiles` of values with their counts: one row for each group and value, in which the value occurs so often.

    The counts are dealt into ranges by group and value. Sums of the ranges tell which of them have the wanted ranks; only in
    those a running sum finds the values. What is broadcast has a row for each group and point, or for each group and range.
    """
    keys = list(by) or ["_all"]
    counts = table.filter(F.col(value).isNotNull() & (F.col(count) > 0)).select(*(by or [F.lit(0).alias("_all")]), F.col(value).cast("double").alias("_value"), F.col(count).alias("_count"))
    placed = stage(counts.repartitionByRange(*keys, "_value").withColumn("_range", F.spark_partition_id()), "value-counts")
    sums = placed.groupBy(*keys, "_range").agg(F.sum("_count").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    at = F.posexplode(F.array(*(F.lit(float(p)) for p in points))).alias("_i", "_p")
    ranks = sums.groupBy(*keys).agg(F.sum("_sum").alias("_n")).select(*keys, "_n", at).withColumn("_rank", (F.col("_n") - 1) * F.col("_p"))
    ranks = ranks.select(*keys, "_i", "_rank", F.floor("_rank").alias("_low"), F.ceil("_rank").alias("_high"))
    inside = lambda rank, first, size: (F.col(first) <= F.col(rank)) & (F.col(rank) < F.col(first) + F.col(size))
    wanted = ranges.join(F.broadcast(ranks), keys).filter(inside("_low", "_before", "_sum") | inside("_high", "_before", "_sum"))
    wanted = wanted.select(*keys, "_range", "_before").distinct()
    running = Window.partitionBy(*keys, "_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    near = placed.join(F.broadcast(wanted), [*keys, "_range"]).withColumn("_first", F.col("_before") + F.coalesce(F.sum("_count").over(running), F.lit(0)))
    found = near.join(F.broadcast(ranks), keys).filter(inside("_low", "_first", "_count") | inside("_high", "_first", "_count"))
    ends = found.groupBy(*keys, "_i", "_rank", "_low", "_high").agg(
        F.max(F.when(inside("_low", "_first", "_count"), F.col("_value"))).alias("_a"), F.max(F.when(inside("_high", "_first", "_count"), F.col("_value"))).alias("_b")
    )
    between = (F.col("_high") - F.col("_rank")) * F.col("_a") + (F.col("_rank") - F.col("_low")) * F.col("_b")
    one = ends.select(*keys, "_i", F.when(F.col("_low") == F.col("_high"), F.col("_a")).otherwise(between).alias("_q"))
    rows = F.array_sort(F.collect_list(F.struct("_i", "_q")))
    return one.groupBy(*keys).agg(F.transform(rows, lambda r: r["_q"]).alias(name)).select(*by, name)


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Add each row's number within its group, in the given order, which has no ties.

    Rows are dealt into ranges of group and order, numbered within their range, and moved on by the rows of the ranges before:
    few large groups keep all tasks busy. What is broadcast has a row for each group and range.
    """
    placed = stage(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = placed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*by, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    numbered = placed.withColumn("_within", within).join(F.broadcast(before), [*by, "_range"])
    return numbered.select(*df.columns, (F.col("_before") + F.col("_within") + (start - 1)).cast("long").alias(name))
