"""Merges as pure functions from old table and changes to new table.

Parquet tables have no MERGE; a caller writes the result as a new version (see ``lodestone.sources.sinks``). Each
function shuffles both sides once, by the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_only(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target lacks, once each: what an idempotent insert appends."""
    return rows.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")


def fill_where_null(target: DataFrame, values: DataFrame, keys: Sequence[str], column: str, stamp: str | None = None, stamp_value: Column | None = None) -> DataFrame:
    """The target with ``column`` filled from ``values`` where it is null, and ``stamp`` set in the rows that were filled."""
    new = values.select(*keys, F.col(column).alias("_new"))
    joined = target.join(new, list(keys), "left")
    filled = F.col(column).isNull() & F.col("_new").isNotNull()
    replaced = {column: F.coalesce(column, "_new")}
    if stamp:
        replaced[stamp] = F.when(filled, stamp_value).otherwise(F.col(stamp))
    return joined.select(*(replaced.get(c, F.col(c)).alias(c) for c in target.columns))


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with rows of a known key replaced and others added; ``rows`` has one row per key."""
    kept = target.join(rows.select(*keys), list(keys), "left_anti")
    return kept.unionByName(rows.select(*target.columns))


def delete_orphans(target: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The target's rows whose key still has a parent."""
    return target.join(parents.select(key), key, "left_semi")


def stale_keys(documents: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Documents (id, content hash, ...) that no current row has: what an incremental run must work on."""
    return documents.join(current.select(*keys), list(keys), "left_anti")
