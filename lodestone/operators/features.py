"""Causal window features and labels of a unit observed over cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_cycle(df: DataFrame, unit: str, order: Sequence[str], name: str = "cycle") -> DataFrame:
    """Number the rows of each unit from 1 in the given order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(unit).orderBy(*order)))


def causal_features(df: DataFrame, unit, cycle: str, values: Sequence[str], window: int = 10, lag: int = 5) -> DataFrame:
    """Add the trailing mean over ``window`` rows and the difference to ``lag`` rows before (0.0 where there is none).

    Only the row itself and earlier rows of its unit count. All columns share one window, so the
    plan has one exchange, one sort and one Window node however many values there are.
    """
    keys = [unit] if isinstance(unit, str) else list(unit)
    w = Window.partitionBy(*keys).orderBy(cycle)
    trailing = w.rowsBetween(1 - window, 0)
    return df.select(
        "*",
        *(F.avg(v).over(trailing).alias(f"{v}_mean_{window}") for v in values),
        *(F.coalesce(F.col(v) - F.lag(v, lag).over(w), F.lit(0.0)).alias(f"{v}_delta_{lag}") for v in values),
    )


def countdown_label(df: DataFrame, unit, cycle: str, cap: int = 125, name: str = "rul") -> DataFrame:
    """Cycles left until the unit's last row, at most ``cap``."""
    keys = [unit] if isinstance(unit, str) else list(unit)
    last = F.max(cycle).over(Window.partitionBy(*keys))
    return df.withColumn(name, F.least(F.lit(cap), last - F.col(cycle)))


def endpoint_rows(df: DataFrame, unit, cycle: str) -> DataFrame:
    """Each unit's rows at its last cycle."""
    keys = [unit] if isinstance(unit, str) else list(unit)
    return (
        df.withColumn("_last", F.max(cycle).over(Window.partitionBy(*keys)))
        .filter(F.col(cycle) == F.col("_last"))
        .drop("_last")
    )
