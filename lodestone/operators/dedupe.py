"""Conflicts between copies of a key, and which copy of a row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def conflicts(df: DataFrame, keys: Sequence[str], payload: Sequence[str], name: str = "payload_versions") -> DataFrame:
    """Keys with more than one distinct payload, and how many."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(*payload)).alias(name)).filter(F.col(name) > 1)


def clean(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per key whose copies all agree; keys in conflict are left out.

    One aggregation settles both: smallest and largest payload of a key are equal exactly if all are. It
    combines map-side and needs neither a second scan nor a join.
    """
    low, high = F.min(F.struct(*payload)).alias("_low"), F.max(F.struct(*payload)).alias("_high")
    return df.groupBy(*keys).agg(low, high).filter(F.col("_low").eqNullSafe(F.col("_high"))).select(*keys, "_low.*")


def latest_copy(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each key's rows the first in ``order`` (latest landing first), deterministic if the order is total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def first_delivery(df: DataFrame, keys: Sequence[str], order: Sequence[Column], copies: str = "copies") -> DataFrame:
    """Of each key's rows the first in ``order``, and how many there were."""
    own = Window.partitionBy(*keys)
    ranked = df.withColumn("_rank", F.row_number().over(own.orderBy(*order))).withColumn(copies, F.count(F.lit(1)).over(own))
    return ranked.filter("_rank = 1").drop("_rank")


def label_count(df: DataFrame, keys: Sequence[str], name: str = "label_count") -> DataFrame:
    """Add the number of rows of each key, for the rule that there is exactly one."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
