"""Writers: versioned overwrite, snapshots, partitioned exports with manifests, no-overwrite landing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = (re.fullmatch(r"v(\d+)", s.getPath().getName()) for s in fs.listStatus(p))
    done = [int(m[1]) for m in found if m]
    return sorted(v for v in done if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v{v}/_SUCCESS")))


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest (or the given) finished version of a table."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no version under {path}")
    return spark.read.parquet(f"{path}/v{known[-1] if version is None else version}")


def replace(df: DataFrame, path: str, columns: list[str] | None = None) -> int:
    """Write ``df`` as the next version. The old one stays readable, so ``df`` may be made from it; a half-written one never counts.

    With ``columns`` a table of other columns is refused, as schemas don't drift silently.
    """
    if columns is not None and df.columns != columns:
        raise ValueError(f"columns {df.columns} are not {columns}")
    spark = df.sparkSession
    known = versions(spark, path)
    version = (known[-1] if known else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v{version}")
    return version


def append_snapshot(df: DataFrame, path: str, stamp: str = "computed_at", who: str | None = None) -> None:
    """Append the rows with the time of writing, and on demand its user in the column ``who``; readers choose the newest."""
    stamped = df.withColumn(stamp, F.current_timestamp())
    (stamped.withColumn(who, F.current_user()) if who else stamped).write.mode("append").parquet(path)


def land(df: DataFrame, path: str) -> None:
    """Write once; a second writer fails."""
    df.write.mode("errorifexists").parquet(path)


def export_by(df: DataFrame, path: str, column: str) -> DataFrame:
    """JSON lines in one folder per value of ``column``, and the manifest of what was written: (value, rows, digest)."""
    rows = df.withColumn("_line", F.to_json(F.struct(*df.columns)))
    manifest = rows.groupBy(column).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("_line").cast("decimal(38,0)")).cast("string").alias("digest"))
    fs, p = _fs(df.sparkSession, path)
    if fs.exists(p):
        old = df.sparkSession.read.parquet(f"{path}.manifest")
        if manifest.exceptAll(old.select(*manifest.columns)).union(old.select(*manifest.columns).exceptAll(manifest)).take(1):
            raise ValueError(f"{path} holds other rows")
        return old
    df.write.partitionBy(column).json(path)
    manifest.coalesce(1).write.parquet(f"{path}.manifest")
    return df.sparkSession.read.parquet(f"{path}.manifest")
