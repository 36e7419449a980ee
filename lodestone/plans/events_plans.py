"""Time-series queries over ``events``: each user is a unit, the row number by time its cycle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestone.catalog import load, run_dir
from lodestone.functions import unit_partition
from lodestone.operators import refresh
from lodestone.operators.checks import digest, ledger, offset_contiguity, one_to_one, sequence_check
from lodestone.operators.dedupe import label_count
from lodestone.operators.expect import Rules
from lodestone.operators.features import causal_features, countdown_label, endpoint_rows, with_cycle
from lodestone.operators.metrics import percentiles
from lodestone.operators.quantiles import row_numbers
from lodestone.plans.registry import query
from lodestone.streaming.ingest import event_batches, produce

CYCLES = """c AS (SELECT event_id, user_id, event_type, value, ts,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle FROM events)"""


def cycles(spark, sf_dir):
    return with_cycle(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def rounded(*names, places=6):
    return [F.round(n, places).alias(n) for n in names]


@query(
    "causal_features",
    f"""WITH {CYCLES} SELECT event_id, user_id, cycle, round(value, 6) AS value,
  round(avg(value) OVER (PARTITION BY user_id ORDER BY cycle ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS value_mean_10,
  round(coalesce(value - lag(value, 5) OVER (PARTITION BY user_id ORDER BY cycle), 0.0), 6) AS value_delta_5 FROM c""",
)
def _(spark, sf_dir):
    out = causal_features(cycles(spark, sf_dir), "user_id", "cycle", ["value"])
    return out.select("event_id", "user_id", "cycle", *rounded("value", "value_mean_10", "value_delta_5"))


def _countdown_sql(cap):
    return f"WITH {CYCLES} SELECT event_id, user_id, cycle, least({cap}, max(cycle) OVER (PARTITION BY user_id) - cycle) AS rul FROM c"


@query("countdown_label", _countdown_sql(125))
def _(spark, sf_dir):
    return countdown_label(cycles(spark, sf_dir), "user_id", "cycle").select("event_id", "user_id", "cycle", "rul")


@query("countdown_label_capped", _countdown_sql(30))
def _(spark, sf_dir):
    return countdown_label(cycles(spark, sf_dir), "user_id", "cycle", cap=30).select("event_id", "user_id", "cycle", "rul")


@query(
    "endpoint_rows",
    f"""WITH {CYCLES}, f AS (SELECT *, max(cycle) OVER (PARTITION BY user_id) AS last,
  avg(value) OVER (PARTITION BY user_id ORDER BY cycle ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m FROM c),
l AS (SELECT user_id, max(value) AS rul FROM events WHERE user_id % 7 <> 0 GROUP BY user_id)
SELECT f.user_id, f.cycle, round(f.m, 6) AS value_mean_10, round(l.rul, 6) AS rul FROM f LEFT JOIN l ON f.user_id = l.user_id WHERE f.cycle = f.last""",
)
def _(spark, sf_dir):
    labels = load(spark, sf_dir, "events").filter("user_id % 7 <> 0").groupBy("user_id").agg(F.max("value").alias("rul"))
    ends = endpoint_rows(causal_features(cycles(spark, sf_dir), "user_id", "cycle", ["value"]), "user_id", "cycle")
    return ends.join(labels, "user_id", "left").select("user_id", "cycle", *rounded("value_mean_10", "rul"))


@query("label_cardinality", "SELECT label_count, count(*) AS rows, bool_and(label_count = 1) AS valid FROM (SELECT count(*) OVER (PARTITION BY user_id, event_type) AS label_count FROM events) GROUP BY label_count")
def _(spark, sf_dir):
    counted = label_count(load(spark, sf_dir, "events"), ["user_id", "event_type"])
    return counted.groupBy("label_count").agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("label_count") == 1).alias("valid"))


# Rules over events; the parsed props must be an object of exactly one key.
EVENT_RULES = Rules(
    {
        "known_type": "event_type IN ('view', 'click', 'purchase', 'signup')",
        "value_range": "value BETWEEN 1 AND 200",
        "props_object": "json_object_keys(props) IS NOT NULL",
        "exact_keys": "array_sort(json_object_keys(props)) = array('k')",
        "key_domain": "k BETWEEN 0 AND 89",
    }
)
EVENT_RULES_SQL = {
    "known_type": "event_type IN ('view', 'click', 'purchase', 'signup')",
    "value_range": "value BETWEEN 1 AND 200",
    "props_object": "json_type(props) = 'OBJECT'",
    "exact_keys": "list_sort(json_keys(props)) = ['k']",
    "key_domain": "k BETWEEN 0 AND 89",
}
EVENTS_K = "e AS (SELECT *, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
FAILED_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({r}, false) THEN '{n}' END" for n, r in EVENT_RULES_SQL.items()) + ")"
VALID_SQL = " AND ".join(f"coalesce({r}, false)" for r in EVENT_RULES_SQL.values())


def parsed_events(spark, sf_dir):
    return load(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k INT")["k"])


@query("quarantine_events", f"WITH {EVENTS_K} SELECT event_id, {FAILED_SQL} AS failed_rules FROM e WHERE NOT ({VALID_SQL})")
def _(spark, sf_dir):
    return EVENT_RULES.quarantine(parsed_events(spark, sf_dir)).select("event_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("valid_events", f"WITH {EVENTS_K} SELECT event_id, user_id, k FROM e WHERE {VALID_SQL}")
def _(spark, sf_dir):
    return EVENT_RULES.valid(parsed_events(spark, sf_dir)).select("event_id", "user_id", "k")


@query("failed_rules", f"WITH {EVENTS_K} SELECT {FAILED_SQL} AS failed_rules, count(*) AS events FROM e GROUP BY 1")
def _(spark, sf_dir):
    checked = EVENT_RULES.check(parsed_events(spark, sf_dir))
    return checked.groupBy(F.array_join("failed_rules", ",").alias("failed_rules")).agg(F.count(F.lit(1)).alias("events"))


@query(
    "rule_metrics",
    f"WITH {EVENTS_K} " + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (coalesce({r}, false)) AS passed, count(*) FILTER (NOT coalesce({r}, false)) AS failed FROM e" for n, r in EVENT_RULES_SQL.items()),
)
def _(spark, sf_dir):
    return EVENT_RULES.metrics(parsed_events(spark, sf_dir))


@query(
    "observed_rules",
    f"WITH {EVENTS_K} " + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (coalesce({r}, false)) AS passed, count(*) FILTER (NOT coalesce({r}, false)) AS failed FROM e" for n, r in EVENT_RULES_SQL.items()),
)
def _(spark, sf_dir):
    """The counts of the write that parts valid rows from quarantine."""
    return EVENT_RULES.write_split(parsed_events(spark, sf_dir), f"{run_dir(spark)}/observed-{uuid.uuid4().hex}")[2]


@query(
    "late_refresh",
    f"""WITH {CYCLES} SELECT event_id, user_id, cycle, round(value, 6) AS value,
  round(avg(value) OVER (PARTITION BY user_id ORDER BY cycle ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS value_mean_10,
  round(coalesce(value - lag(value, 5) OVER (PARTITION BY user_id ORDER BY cycle), 0.0), 6) AS value_delta_5 FROM c""",
)
def _(spark, sf_dir):
    """Features of a table that a seventh of a tenth of the users' events reaches late: only those users are worked out again."""
    root = f"{run_dir(spark)}/late-{uuid.uuid4().hex}"
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    late = (F.col("user_id") % 10 == 3) & (F.col("event_id") % 7 == 2)
    make = lambda rows: causal_features(with_cycle(rows, "user_id", ["ts", "event_id"]), "user_id", "cycle", ["value"])
    refresh.append_rows(events.filter(~late), f"{root}/bronze", "user_id")
    refresh.rebuild(spark, f"{root}/bronze", make, f"{root}/gold", "user_id")
    refresh.append_rows(events.filter(late), f"{root}/bronze", "user_id")
    refresh.refresh_units(events.filter(late), f"{root}/bronze", make, f"{root}/gold", "user_id")
    return spark.read.parquet(f"{root}/gold").select("event_id", "user_id", "cycle", *rounded("value", "value_mean_10", "value_delta_5"))


@query("enforced_events", "SELECT count(*) AS events, count(DISTINCT user_id) AS users FROM events WHERE value IS NOT NULL AND user_id >= 0")
def _(spark, sf_dir):
    rules = Rules({"has_value": "value IS NOT NULL", "user": "user_id >= 0"})
    return rules.enforce(load(spark, sf_dir, "events")).agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))


DELIVERED = "d AS (SELECT user_id, cycle, user_id % 4 AS part, row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS off FROM c)"


def delivered(spark, sf_dir):
    return row_numbers(cycles(spark, sf_dir).withColumn("part", F.col("user_id") % 4), ["part"], ["ts", "event_id"], "off", start=0)


@query("offset_contiguity", f"WITH {CYCLES}, {DELIVERED} SELECT part, count(*) AS rows, min(off) AS first_offset, max(off) AS last_offset, max(off) - min(off) + 1 = count(*) AS contiguous FROM d GROUP BY part")
def _(spark, sf_dir):
    return offset_contiguity(delivered(spark, sf_dir), "part", "off")


@query(
    "sequence_check",
    f"""WITH {CYCLES}, {DELIVERED}, s AS (SELECT user_id, part, cycle <= lag(cycle) OVER (PARTITION BY user_id, part ORDER BY off) AS back FROM d)
SELECT user_id, count(*) FILTER (back) AS out_of_order, count(DISTINCT part) AS partitions FROM s GROUP BY user_id""",
)
def _(spark, sf_dir):
    return sequence_check(delivered(spark, sf_dir), "user_id", "part", "off", "cycle")


@query("latency_percentiles", "SELECT round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, max(value) AS max FROM events")
def _(spark, sf_dir):
    return percentiles(load(spark, sf_dir, "events"), "value", {"p50": 0.5, "p95": 0.95}).select(*rounded("p50", "p95"), "max")


@query("score_summary", "SELECT round(median(value), 6) AS median, min(value) AS lowest, max(value) AS highest, count(*) FILTER (value < 20) AS below FROM events")
def _(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    ends = e.agg(F.min("value").alias("lowest"), F.max("value").alias("highest"), F.count_if(F.col("value") < 20).alias("below"))
    return ends.join(percentiles(e, "value", {"median": 0.5}).select(*rounded("median")))  # one row each


@query("distinct_counts", "SELECT count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT (user_id, event_type)) AS pairs, count(DISTINCT json_extract_string(props, '$.k')) AS props FROM events")
def _(spark, sf_dir):
    return load(spark, sf_dir, "events").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"), F.count_distinct(F.struct("user_id", "event_type")).alias("pairs"), F.count_distinct(F.get_json_object("props", "$.k")).alias("props")
    )


@query(
    "one_to_one_alignment",
    """WITH a AS (SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1), b AS (SELECT c_custkey AS id, count(*) AS n FROM customer GROUP BY 1)
SELECT count(*) FILTER (b.n IS NULL) AS left_only, count(*) FILTER (a.n IS NULL) AS right_only, count(*) FILTER (a.n > 1 OR b.n > 1) AS repeated FROM a FULL JOIN b USING (id)""",
)
def _(spark, sf_dir):
    a = load(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    b = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return one_to_one(a, b, ["id"])


@query(
    "produced_events",
    f"""WITH {CYCLES}, p AS (SELECT user_id + 1 AS unit, cycle, value FROM c)
SELECT unit, cycle, printf('EV-%03d-%03d', unit, cycle) AS event_id, CAST((unit - 1) % 4 AS INTEGER) AS part,
  row_number() OVER (PARTITION BY (unit - 1) % 4 ORDER BY unit, cycle) - 1 AS off FROM p""",
)
def _(spark, sf_dir):
    return produced(spark, sf_dir).select("unit", "cycle", "event_id", F.col("partition").alias("part"), F.col("offset").alias("off"))


def produced(spark, sf_dir):
    rows = cycles(spark, sf_dir).select((F.col("user_id") + 1).alias("unit"), "cycle", "value")
    return produce(rows, "unit", "cycle", [("EV-%03d", F.col("unit")), ("-%03d", F.col("cycle"))], ["value"], 4)


@query(
    "produced_batches",
    f"""WITH RECURSIVE {CYCLES}, p AS (SELECT user_id + 1 AS unit, cycle, value FROM c),
e AS (SELECT CAST((unit - 1) % 4 AS INTEGER) AS part, row_number() OVER (PARTITION BY (unit - 1) % 4 ORDER BY unit, cycle) - 1 AS off,
  strlen(printf('{{"event_id":"EV-%03d-%03d","unit":%d,"cycle":%d,"value":', unit, cycle, unit, cycle) || CAST(value AS VARCHAR) || '}}') + 1 AS len FROM p),
b AS (SELECT part, off, len, 0 AS batch, 1 AS n, 2 + len AS size FROM e WHERE off = 0
  UNION ALL SELECT e.part, e.off, e.len, CASE WHEN b.n = 100 OR b.size + e.len > 16384 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.n = 100 OR b.size + e.len > 16384 THEN 1 ELSE b.n + 1 END,
  CASE WHEN b.n = 100 OR b.size + e.len > 16384 THEN 2 + e.len ELSE b.size + e.len END FROM b JOIN e ON e.part = b.part AND e.off = b.off + 1)
SELECT part AS partition, batch, count(*) AS events, CAST(sum(len) AS BIGINT) AS bytes, min(off) AS first FROM b GROUP BY part, batch""",
)
def _(spark, sf_dir):
    placed = event_batches(produced(spark, sf_dir), 16_384, 100)
    return placed.groupBy("partition", "batch").agg(F.count(F.lit(1)).alias("events"), F.sum(F.octet_length("payload") + 1).alias("bytes"), F.min("offset").alias("first"))


@query("unit_partitions", "SELECT user_id, CAST((user_id - 1 + 8) % 8 AS BIGINT) AS part FROM (SELECT DISTINCT user_id FROM events)")
def _(spark, sf_dir):
    return load(spark, sf_dir, "events").select("user_id").distinct().select("user_id", unit_partition(F.col("user_id"), 8).alias("part"))


@query(
    "content_digest",
    """SELECT count(*) AS rows, CAST(sum(CAST('0x' || left(md5(concat_ws('|', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR))), 15) AS HUGEINT)) AS VARCHAR) AS digest FROM events""",
)
def _(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.floor(F.col("value") * 1000).cast("long").alias("thousandths"))
    return digest(e, kind="md5")


@query(
    "row_ledger",
    """SELECT 'events' AS "table", (SELECT count(*) FROM events) AS rows, (SELECT count(*) FROM events) AS expected, true AS agrees
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(DISTINCT o_orderkey) FROM orders), (SELECT count(*) = count(DISTINCT o_orderkey) FROM orders)
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)), count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'nation', count(*), 25, count(*) = 25 FROM nation""",
)
def _(spark, sf_dir):
    tables = {t: load(spark, sf_dir, t) for t in ("events", "orders", "lineitem", "nation")}
    return ledger(tables, {"orders": tables["orders"].select("o_orderkey").distinct().count(), "events": tables["events"].select("event_id").distinct().count(), "lineitem": tables["lineitem"].select("l_orderkey", "l_linenumber").distinct().count(), "nation": 25})
