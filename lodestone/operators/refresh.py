"""Tables of units that are brought up to date where input is new or late: only what changed is worked out and written again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage

#: Buckets of a table: how finely it can be rewritten.
BUCKETS = 64
BUCKET = "bucket"


def bucket_of(unit: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(unit), F.lit(buckets)).cast("int")


def append_rows(rows: DataFrame, path: str, unit: str, buckets: int = BUCKETS) -> None:
    """Append rows to a table that is stored by its units' buckets; one file a bucket, so that appends don't leave many small ones."""
    placed = rows.withColumn(BUCKET, bucket_of(F.col(unit), buckets))
    placed.repartition(BUCKET).write.partitionBy(BUCKET).mode("append").parquet(path)


def rebuild(spark: SparkSession, source: str, make: Callable[[DataFrame], DataFrame], path: str, unit: str, buckets: int = BUCKETS) -> None:
    """Make the whole table from all of its source."""
    made = make(spark.read.parquet(source).drop(BUCKET)).withColumn(BUCKET, bucket_of(F.col(unit), buckets))
    made.repartition(BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(path)


def refresh_units(new: DataFrame, source: str, make: Callable[[DataFrame], DataFrame], path: str, unit: str, buckets: int = BUCKETS) -> int:
    """Bring the table up to date after ``new`` rows were appended to its source; returns how many units were worked out again.

    ``make`` works on each unit by itself, so the rows of units that new rows name are made anew, from all their rows: one that
    comes late changes what is after it, as a full rebuild would. Only the buckets of those units are read, from both tables, and replaced, by
    a write that commits its partitions at the end; files of other buckets stay as they are. Which buckets those are
    comes to the driver: a number of at most ``buckets`` values. Null units are a unit of their own.
    """
    spark = new.sparkSession
    changed = stage(new.select(unit).distinct(), "changed")
    touched = [r[0] for r in changed.select(bucket_of(F.col(unit), buckets)).distinct().collect()]
    units = changed.count()
    if not units:
        return 0
    own = changed.select(F.col(unit).alias("_lodestone_unit"))
    same = F.col(unit).eqNullSafe(F.col("_lodestone_unit"))
    inputs = spark.read.parquet(source).filter(F.col(BUCKET).isin(touched)).join(own, same, "left_semi").drop(BUCKET)
    before = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched))
    made = make(inputs).withColumn(BUCKET, bucket_of(F.col(unit), buckets))
    rows = stage(before.join(own, same, "left_anti").unionByName(made), "refreshed")
    rows.repartition(BUCKET).write.partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    discard(rows)
    discard(changed)
    return units
