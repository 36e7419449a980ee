"""Triggered streams: every file or event once, a rerun without new input adds nothing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.catalog import stage
from lodestone.functions import event_key, unit_partition
from lodestone.operators.quantiles import row_numbers


def ingest(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append all that is there and not yet ingested; returns the rows added.

    Rows are counted before and after, which reads the footers of the table's files; a query's progress reports go back only
    so far.
    """
    before = _rows(stream.sparkSession, path)
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return _rows(stream.sparkSession, path) - before


def _rows(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(p) and any(s.getPath().getName().endswith(".parquet") or s.isDirectory() and s.getPath().getName() != "_spark_metadata" for s in fs.listStatus(p))
    return spark.read.parquet(path).count() if there else 0


def append_flows(flows: dict[str, DataFrame], path: str, checkpoints: str) -> dict[str, int]:
    """Several sources into one table: each flow has a checkpoint and a partition ``flow`` of its own name.

    A file sink counts the batches of one query, so queries don't share a folder.
    """
    return {name: ingest(df, f"{path}/flow={name}", f"{checkpoints}/{name}") for name, df in flows.items()}


def parquet_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def kafka_options(servers: str, topic: str, user: str | None = None, password: str | None = None, login: str = "org.apache.kafka.common.security.plain.PlainLoginModule") -> dict[str, str]:
    """The reader's options: the topic from its beginning, failing on lost data; with a user, over TLS with that login.

    ``login`` is the class that the cluster's Kafka client has for it, which some distributions rename.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "true"}
    if user is None:
        return options
    quoted = lambda x: '"' + (x or "").replace("\\", "\\\\").replace('"', '\\"') + '"'
    # The login and both time-outs.
    return options | {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f"{login} required username={quoted(user)} password={quoted(password)};",
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "30000",
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None, **login: str) -> DataFrame:
    """key, payload, topic, partition, offset and enqueued_at of the topic's records; see :func:`kafka_options`."""
    return transport(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **login), **(options or {})).load())


def transport(records: DataFrame) -> DataFrame:
    """A Kafka record's columns under the names that bronze tables have."""
    return records.select(
        F.col("key").cast("string"), F.col("value").cast("string").alias("payload"), "topic", "partition", "offset", F.col("timestamp").alias("enqueued_at")
    )


def produce(rows: DataFrame, unit: str, cycle: str, id_parts: Sequence[tuple[str, Column]], values: Sequence[str], partitions: int) -> DataFrame:
    """Events of the rows: partition, offset within it in (unit, cycle) order, event id and JSON payload."""
    body = F.to_json(F.struct(event_key(*id_parts).alias("event_id"), unit, cycle, *values))
    events = rows.select(unit, cycle, event_key(*id_parts).alias("event_id"), unit_partition(F.col(unit), partitions).cast("int").alias("partition"), body.alias("payload"))
    # Places within a unit, after as many events as the partition's earlier units have: there are few units for many events.
    sizes = events.groupBy("partition", unit).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("partition").orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("partition", unit, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("partition", unit).orderBy(cycle)) - 1
    return events.withColumn("_place", place).join(starts, ["partition", unit]).withColumn("offset", (F.col("_start") + F.col("_place")).cast("long")).select(*events.columns, "offset")


#: Events of a chunk, the piece of a partition that a task works on.
CHUNK = 1 << 16


def _next_starts(size: np.ndarray, own: int, max_bytes: int, max_events: int) -> np.ndarray:
    """Where the next batch starts if one starts at each of the first ``own`` places; ``size`` goes on beyond those."""
    total = np.concatenate(([0], np.cumsum(size + 1)))
    place = np.arange(own)
    full = np.searchsorted(total, total[:own] + (max_bytes - 2), side="right") - 1
    return np.maximum(place + 1, np.minimum(place + max_events, full))


def event_batches(events: DataFrame, max_bytes: int, max_events: int) -> DataFrame:
    """Add ``batch``: events of a partition in order, a new batch where the count or the bytes would be exceeded.

    Where a batch starts depends on all before it in its partition, but where the next one starts only on what follows. So
    partitions are numbered by ranges and cut into chunks; each chunk tells for every place at which a batch may first start in
    it, of which there are ``max_events``, at which place of the next chunk that leads to. These short tables are put together by doubling (two chunks,
    four, ...), which gives each chunk the place it really starts at, and the number of batches before. Then each chunk marks its own. A
    partition of any size keeps all tasks busy; a task holds a chunk and ``max_events`` events more.
    """
    chunk = max(CHUNK, max_events)
    sized = events.select("partition", "offset", F.octet_length("payload").alias("bytes"))
    numbered = row_numbers(sized, ["partition"], ["offset"], "_at", start=0).withColumn("_chunk", F.floor(F.col("_at") / chunk))
    # The first events of a chunk also end the last batch of the one before.
    behind = F.when((F.col("_at") % chunk < max_events) & (F.col("_chunk") > 0), F.col("_chunk") - 1)
    seen = stage(numbered.withColumn("_of", F.explode(F.array_compact(F.array("_chunk", behind)))), "chunks")

    def ordered(table: pa.Table) -> tuple[pa.Table, int]:
        table = table.sort_by("_at")
        return table, int((table["_chunk"].to_numpy() == table["_of"][0].as_py()).sum())

    def leads(table: pa.Table) -> pa.Table:
        table, own = ordered(table)
        after = _next_starts(table["bytes"].to_numpy(), own, max_bytes, max_events)
        leave, starts = after.copy(), np.ones(own, np.int64)
        for i in range(own - 1, -1, -1):
            if after[i] < own:
                leave[i], starts[i] = leave[after[i]], starts[after[i]] + 1
        n, first = min(own, max_events), table["_of"][0].as_py()
        same = [pa.array(np.full(n, x)) for x in (table["partition"][0].as_py(), first)]
        return pa.table([same[0].cast(pa.int32()), same[1], pa.array(np.arange(n)), pa.array(leave[:n] - own), pa.array(starts[:n])], names=["partition", "chunk", "place", "to", "starts"])

    step = stage(seen.groupBy("partition", "_of").applyInArrow(leads, "partition int, chunk long, place long, to long, starts long"), "steps")
    last = step.agg(F.max("chunk")).first()[0] or 0
    steps, wide = [], 1
    while wide <= last:
        steps.append((wide, step))
        then = step.select("partition", (F.col("chunk") - wide).alias("chunk"), F.col("place").alias("to"), F.col("to").alias("_to"), F.col("starts").alias("_starts"))
        two = step.filter(F.col("chunk") % (2 * wide) == 0).join(then, ["partition", "chunk", "to"])
        wide *= 2
        if wide <= last:
            step = stage(two.select("partition", "chunk", "place", F.col("_to").alias("to"), (F.col("starts") + F.col("_starts")).alias("starts")), "steps")
    entered = seen.select("partition").distinct().select("partition", F.lit(0).cast("long").alias("chunk"), F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("before"))
    for wide, step in reversed(steps):
        on = entered.join(step, ["partition", "chunk", "place"])
        entered = stage(entered.unionAll(on.select("partition", F.col("chunk") + wide, "to", F.col("before") + F.col("starts"))), "entered")

    def mark(table: pa.Table) -> pa.Table:
        table, own = ordered(table)
        after = _next_starts(table["bytes"].to_numpy(), own, max_bytes, max_events)
        at, starts = table["place"][0].as_py(), np.zeros(own, np.int64)
        while at < own:
            starts[at], at = 1, int(after[at])
        batch = np.cumsum(starts) + (table["before"][0].as_py() - 1)
        return pa.table([table["partition"].slice(0, own), table["offset"].slice(0, own), pa.array(batch.astype(np.int32))], names=["partition", "offset", "batch"])

    placed = seen.join(entered.select("partition", F.col("chunk").alias("_of"), "place", "before"), ["partition", "_of"])
    batches = placed.groupBy("partition", "_of").applyInArrow(mark, "partition int, offset long, batch int")
    return events.join(batches, ["partition", "offset"])


def windowed_counts(stream: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per tumbling window and key; events later than ``late`` are left out. An extra beyond batch marts."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), key).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))
