"""Reading input tables and managing working tables in the folder all nodes share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table's Parquet file or folder. Paths go to Spark's readers only, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset, as on a single machine, a temporary folder is made and recorded.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_lodestone_shared", None)
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        known = spark._lodestone_shared = tempfile.mkdtemp(prefix="lodestone-")
    return known.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's working tables. What is in it is deleted when the session's process ends in order."""
    own = f"{shared_dir(spark)}/lodestone/{spark.sparkContext.applicationId}"
    if getattr(spark, "_lodestone_run", None) != own:
        spark._lodestone_run = own
        atexit.register(_forget, spark, own)
    return own


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def clean(spark: SparkSession) -> None:
    """Delete all working tables of this application; results that still read them can't be evaluated afterwards."""
    fs, path = _path(spark, run_dir(spark))
    fs.delete(path, True)


def _forget(spark: SparkSession, path: str) -> None:
    # At the end of the process the JVM may be gone, and its tables with the cluster that made them.
    with contextlib.suppress(Exception):
        fs, p = _path(spark, path)
        fs.delete(p, True)


def stage(df: DataFrame, name: str, spark: SparkSession | None = None, codec: str = "zstd", by: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    With ``by`` a folder for each of that column's values, so that a filter on it reads its folder only. With ``schema`` it is read so: vectors
    are stored as structs of their parts.
    """
    spark = spark or df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    release(spark)
    writer = df.write.option("compression", codec)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage: shuffle files of finished plans are deleted with the objects that name them.

    The cleaner's own interval is half an hour, in which a chain of large shuffles would pile up on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stage`; the caller no longer reads it."""
    spark = df.sparkSession
    base = run_dir(spark)
    app = f"/lodestone/{spark.sparkContext.applicationId}/"
    for root in {f.split(app, 1)[1].split("/", 1)[0] for f in df.inputFiles() if app in f}:
        fs, path = _path(spark, f"{base}/{root}")
        fs.delete(path, True)
