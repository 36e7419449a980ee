"""A log of events with offsets that streams can replay: stored by partition, read from the beginning, loud about lost offsets."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lodestone.operators.quantiles import row_numbers

NAME = "lodestone_log"
SCHEMA = "key string, payload string, topic string, partition int, offset long, enqueued_at timestamp"
#: Offsets of a segment, the folder that is written and deleted as a whole; segments are read by a task each.
SEGMENT = 1 << 16
FOLDER = re.compile(r"partition=(\d+)/first=(\d+)/last=(\d+)$")


def append_to_log(events: DataFrame, path: str, partition: Column, order: list[str], key: Column, payload: Column, topic: str, enqueued_at: Column, first: dict[int, int] | None = None) -> None:
    """Append the events, numbered within their partitions in the given order, which has no ties.

    ``first`` has the next offset of each partition (see :func:`next_offsets`). Rows are numbered by ranges, so a large partition
    keeps all tasks busy; a segment's folder has its first and last offset in its name, which is all that a reader needs to plan.
    """
    columns = [partition.cast("int").alias("partition"), key.alias("key"), payload.alias("payload"), enqueued_at.cast("timestamp").alias("enqueued_at"), *(F.col(c).alias(f"_order{i}") for i, c in enumerate(order))]
    rows = row_numbers(events.select(*columns), ["partition"], [f"_order{i}" for i in range(len(order))], "offset", start=0)
    if first:
        start = F.create_map(*(F.lit(x) for pair in first.items() for x in pair))
        rows = rows.withColumn("offset", F.col("offset") + F.coalesce(start[F.col("partition")], F.lit(0)).cast("long"))
    rows = rows.withColumn("_segment", F.floor(F.col("offset") / SEGMENT))
    ends = rows.groupBy("partition", "_segment").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    out = rows.join(F.broadcast(ends), ["partition", "_segment"]).withColumn("topic", F.lit(topic)).repartition("partition", "_segment").sortWithinPartitions("partition", "_segment", "offset")
    names = ["key", "payload", "topic", "offset", "enqueued_at"]
    out.select("partition", "first", "last", *names).write.partitionBy("partition", "first", "last").mode("append").parquet(path)


def _folders(path: str) -> tuple[object, list[tuple[int, int, int, str]]]:
    """(file system, segments as (partition, first, last, folder) in order)."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    found = [(m, i.path) for i in store.get_file_info(fs.FileSelector(root, recursive=True)) if i.type == fs.FileType.Directory and (m := FOLDER.search(i.path))]
    return store, sorted((int(m[1]), int(m[2]), int(m[3]), p) for m, p in found)


def next_offsets(path: str) -> dict[int, int]:
    """The offset after the last one of each partition."""
    return {p: last + 1 for p, _, last, _ in _folders(path)[1]}


@dataclass
class Segment(InputPartition):
    """Offsets ``first`` to before ``end`` of a partition, all in one folder."""

    folder: str
    partition: int
    first: int
    end: int


class LogReader(DataSourceStreamReader):
    """Offsets are a number for each partition: of the first event that is not yet read."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        first: dict[str, int] = {}
        for p, start, _, _ in _folders(self.path)[1]:
            first.setdefault(str(p), start)
        return first

    def latestOffset(self) -> dict:
        return {str(p): n for p, n in next_offsets(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        segments, made = _folders(self.path)[1], []
        for name, to in end.items():
            own = [s for s in segments if s[0] == int(name)]
            at = start.get(name, own[0][1] if own else to)
            for p, first, last, folder in own:
                if first <= at <= last and at < to:
                    made.append(Segment(folder, p, at, min(last + 1, to)))
                    at = last + 1
            if at < to:
                raise ValueError(f"offsets {at} to {to - 1} of partition {name} are gone from {self.path}")
        return made

    def read(self, partition: Segment) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        store, _ = _folders(self.path)
        source = ds.dataset(partition.folder, filesystem=store, format="parquet", partitioning=None)
        wanted = (pc.field("offset") >= partition.first) & (pc.field("offset") < partition.end)
        rows = 0
        for batch in source.to_batches(filter=wanted, columns=["key", "payload", "topic", "offset", "enqueued_at"]):
            rows += batch.num_rows
            place = pa.array([partition.partition] * batch.num_rows, pa.int32())
            times = batch.column(4).cast(pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], place, batch.column(3), times], names=["key", "payload", "topic", "partition", "offset", "enqueued_at"])
        if rows != partition.end - partition.first:
            raise ValueError(f"{partition.end - partition.first - rows} of the offsets {partition.first} to {partition.end - 1} are gone from {partition.folder}")


class LogSource(DataSource):
    """``format("lodestone_log").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"])


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """key, payload, topic, partition, offset and enqueued_at of the log's events, from its beginning.

    A stream goes on where its checkpoint ends. Wanted offsets that the log has no more raise, as do gaps, so that no event is lost in silence.
    """
    spark.dataSource.register(LogSource)
    return spark.readStream.format(NAME).option("path", path).load()
