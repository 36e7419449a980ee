"""Conflicts, evaluation, drift and marts over orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.catalog import load
from lodestone.operators import bi, dedupe, drift, metrics, upsert
from lodestone.operators.checks import numeric_parity, parity
from lodestone.plans.registry import query

KEYS = ["l_orderkey", "l_linenumber"]
PAYLOAD = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("payload_conflicts", f"SELECT l_orderkey, l_linenumber, count(DISTINCT ({', '.join(PAYLOAD)})) AS payload_versions FROM lineitem GROUP BY ALL HAVING count(DISTINCT ({', '.join(PAYLOAD)})) > 1")
def _(spark, sf_dir):
    return dedupe.conflicts(load(spark, sf_dir, "lineitem"), KEYS, PAYLOAD)


@query(
    "clean_observations",
    f"""SELECT l_orderkey, l_linenumber, any_value(l_partkey) AS l_partkey, any_value(l_quantity) AS l_quantity, any_value(l_returnflag) AS l_returnflag
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT ({', '.join(PAYLOAD)})) = 1""",
)
def _(spark, sf_dir):
    return dedupe.clean(load(spark, sf_dir, "lineitem"), KEYS, PAYLOAD).select(*KEYS, "l_partkey", "l_quantity", "l_returnflag")


ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "latest_copy",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in ORDER)}) = 1""",
)
def _(spark, sf_dir):
    out = dedupe.latest_copy(load(spark, sf_dir, "lineitem"), KEYS, [F.col(c).desc() for c in ["l_shipdate", *ORDER]])
    return out.select(*KEYS, "l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


@query(
    "first_delivery",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, {', '.join(ORDER)}) = 1""",
)
def _(spark, sf_dir):
    out = dedupe.first_delivery(load(spark, sf_dir, "lineitem"), KEYS, [F.col(c) for c in ["l_shipdate", *ORDER]])
    return out.select(*KEYS, "l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"), "copies")


@query(
    "parity_full_outer",
    """WITH a AS (SELECT o_orderkey AS k, 1 AS v FROM orders), b AS (SELECT l_orderkey AS k, CAST(min(l_linenumber) AS INTEGER) AS v FROM lineitem GROUP BY 1)
SELECT count(*) FILTER (b.k IS NULL) AS missing, count(*) FILTER (a.k IS NULL) AS extra, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL AND a.v IS DISTINCT FROM b.v) AS different, count(*) AS keys FROM a FULL JOIN b ON a.k = b.k""",
)
def _(spark, sf_dir):
    a = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit(1).alias("v"))
    b = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_linenumber").alias("v"))
    return parity(a, b, ["k"], ["v"])


@query(
    "numeric_parity",
    """WITH l AS (SELECT l_orderkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1), o AS (SELECT l_orderkey AS k, sum(l_quantity) + (CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END) AS v FROM lineitem GROUP BY 1)
SELECT count(*) AS compared, max(abs(l.v - o.v)) AS max_difference, count(*) FILTER (abs(l.v - o.v) > 1e-9) AS mismatches FROM l JOIN o ON l.k = o.k""",
)
def _(spark, sf_dir):
    left = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").alias("v"))
    right = left.select("k", (F.col("v") + F.when(F.col("k") % 50 == 0, 1).otherwise(0)).alias("v"))
    return numeric_parity(left, right, ["k"], "v")


# Days of a nation: the highest order of a day gives the series, in degrees.
@query(
    "monthly_mart",
    """WITH o AS (SELECT n_name AS nation, o_orderdate::DATE AS day, max(o_totalprice) AS top, avg(o_totalprice) AS typical FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
d AS (SELECT nation, day, date_trunc('month', day)::DATE AS m, top / 7013.0 AS highest, typical / 7013.0 AS mean, top / 6007.0 AS felt FROM o)
SELECT nation, strftime(m, '%Y-%m') AS month, CAST(count(*) AS INTEGER) AS days, count(*) = day(last_day(m)) AS complete, round(avg(highest), 6) AS mean_max_c, round(avg(mean), 6) AS mean_c, round(avg(felt), 6) AS mean_apparent_max_c,
  max(highest) AS highest_max_c, max(felt) AS highest_apparent_max_c, CAST(count(*) FILTER (highest * 9 / 5 + 32 >= 90) AS INTEGER) AS days_max_ge_90f, CAST(count(*) FILTER (highest * 9 / 5 + 32 >= 95) AS INTEGER) AS days_max_ge_95f,
  CAST(count(*) FILTER (felt * 9 / 5 + 32 >= 90) AS INTEGER) AS days_apparent_ge_90f, CAST(count(*) FILTER (felt * 9 / 5 + 32 >= 103) AS INTEGER) AS days_apparent_ge_103f FROM d GROUP BY nation, m""",
)
def _(spark, sf_dir):
    # Dimensions are joined as they are: adaptive execution broadcasts those below its size limit.
    orders = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    each = orders.groupBy(F.col("n_name").alias("nation"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("top"), F.avg("o_totalprice").alias("typical"))
    days = each.select("nation", "day", (F.col("top") / 7013.0).alias("highest"), (F.col("typical") / 7013.0).alias("mean"), (F.col("top") / 6007.0).alias("felt"))
    means = {"mean_max_c": "highest", "mean_c": "mean", "mean_apparent_max_c": "felt"}
    hot = {"days_max_ge_90f": ("highest", 90), "days_max_ge_95f": ("highest", 95), "days_apparent_ge_90f": ("felt", 90), "days_apparent_ge_103f": ("felt", 103)}
    out = bi.monthly_mart(days, ["nation"], "day", means, {"highest_max_c": "highest", "highest_apparent_max_c": "felt"}, hot)
    return out.withColumns({name: F.round(name, 6) for name in means})


# A price model: predicted from quantity and list price; the "remaining life" is the price in thousands.
PREDICTED = """p AS (SELECT l_orderkey, l_linenumber, l_returnflag AS version, l_extendedprice / 1000 AS actual, l_quantity * p_retailprice / 1000 AS predicted,
  l_linenumber = 1 AS is_endpoint, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem JOIN part ON l_partkey = p_partkey)"""
SEGMENTS = """s AS (SELECT *, unnest(list_filter(['all', CASE WHEN is_endpoint THEN 'endpoint' END, CASE WHEN actual <= 50 THEN 'actual_le_50' END,
  CASE WHEN actual <= 20 THEN 'bucket_0_20' END, CASE WHEN actual > 20 AND actual <= 50 THEN 'bucket_20_50' END, CASE WHEN actual > 50 AND actual <= 80 THEN 'bucket_50_80' END,
  CASE WHEN actual > 80 THEN 'bucket_80_up' END], lambda x: x IS NOT NULL)) AS segment FROM p)"""
AGGREGATES = """count(*) AS rows, round(sqrt(avg((predicted - actual) ** 2)), 5) AS rmse, round(avg(abs(predicted - actual)), 5) AS mae, round(avg(predicted - actual), 5) AS bias"""


def predicted(spark, sf_dir):
    joined = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        *KEYS, F.col("l_returnflag").alias("version"), (F.col("l_extendedprice") / 1000).alias("actual"), (F.col("l_quantity") * F.col("p_retailprice") / 1000).alias("predicted"), (F.col("l_linenumber") == 1).alias("is_endpoint"), F.date_format("l_shipdate", "yyyy-MM").alias("month")
    )


def performance(spark, sf_dir, version="version"):
    return metrics.segment_performance(predicted(spark, sf_dir), version, "predicted", "actual", "is_endpoint", 50, [20, 50, 80])


@query("regression_segments", f"WITH {PREDICTED}, {SEGMENTS} SELECT version, segment, {AGGREGATES} FROM s GROUP BY ALL")
def _(spark, sf_dir):
    return performance(spark, sf_dir).select("version", "segment", "rows", *(F.round(c, 5).alias(c) for c in ("rmse", "mae", "bias")))


@query(
    "asymmetric_score",
    f"""WITH {PREDICTED}, e AS (SELECT version, (predicted - actual) / 10 AS e FROM p)
SELECT version, round(sum(CASE WHEN e < 0 THEN exp(-e / 13) - 1 ELSE exp(e / 10) - 1 END), 3) AS score FROM e GROUP BY version""",
)
def _(spark, sf_dir):
    e = predicted(spark, sf_dir).select("version", ((F.col("predicted") - F.col("actual")) / 10).alias("e"))
    return e.groupBy("version").agg(F.round(F.sum(metrics.asymmetric_penalty(F.col("e"))), 3).alias("score"))


@query(
    "delayed_labels",
    """WITH p AS (SELECT l_orderkey AS unit, l_linenumber AS cycle, max(l_quantity) AS predicted FROM lineitem GROUP BY ALL), e AS (SELECT o_orderkey AS unit, CAST(1 + o_orderkey % 5 AS INTEGER) AS end_cycle, CAST(o_orderkey % 100 AS INTEGER) AS end_value FROM orders WHERE o_orderstatus = 'F')
SELECT p.unit, cycle, predicted, end_value + end_cycle - cycle AS actual FROM p JOIN e ON p.unit = e.unit WHERE cycle <= end_cycle""",
)
def _(spark, sf_dir):
    log = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit"), F.col("l_linenumber").alias("cycle")).agg(F.max("l_quantity").alias("predicted"))
    ends = load(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").selectExpr("o_orderkey AS unit", "CAST(1 + o_orderkey % 5 AS INT) AS end_cycle", "CAST(o_orderkey % 100 AS INT) AS end_value")
    return bi.label_delayed(log, ends, ["unit"], "cycle", "end_cycle", "end_value").select("unit", "cycle", "predicted", "actual")


FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
AGE = "((extract('year' FROM l_shipdate) - 1995) * 12 + extract('month' FROM l_shipdate))"


def _drift_sql(weighted):
    """The bins' shares on both sides, and their divergence, in plain SQL."""
    edges = ", ".join(f"{i / 10}" for i in range(1, 10))
    sides = f"""r AS (SELECT *, {AGE}::DOUBLE AS age FROM lineitem WHERE l_returnflag = 'R'), c AS (SELECT *, {AGE}::DOUBLE AS age FROM lineitem WHERE l_returnflag <> 'R'),
ce AS (SELECT list_sort(list_distinct(quantile_cont(age, [{edges}]))) AS e, min(age) AS lo, max(age) AS hi FROM c),
ca AS (SELECT len(list_filter(e, lambda x: x <= age)) AS b, count(*) AS n FROM c, ce GROUP BY 1),
ra AS (SELECT len(list_filter(e, lambda x: x <= age)) AS b, count(*) AS n FROM r, ce WHERE age BETWEEN lo AND hi GROUP BY 1),
w AS (SELECT ra.b, (coalesce(ca.n, 0) / (SELECT sum(n) FROM ca)) / (ra.n / (SELECT sum(n) FROM ra)) AS ratio FROM ra LEFT JOIN ca ON ra.b = ca.b),
rw AS (SELECT r.*, CASE WHEN age BETWEEN lo AND hi THEN coalesce(w.ratio, 0) ELSE 0 END AS weight FROM r CROSS JOIN ce LEFT JOIN w ON w.b = len(list_filter(e, lambda x: x <= age)))"""
    part = []
    for f in FEATURES:
        for kind in ("1", "weight") if weighted else ("1",):
            part.append(
                f"""SELECT '{f}' AS feature, '{kind}' AS kind, sum((a - x) * ln(a / x)) AS v FROM (SELECT greatest(coalesce(rb.w, 0) / (SELECT sum({kind}) FROM rw), 1e-6) AS x, greatest(coalesce(cb.n, 0) / (SELECT count(*) FROM c), 1e-6) AS a
FROM (SELECT unnest(range(0, len(e) + 1)) AS b FROM fe_{f}) bins LEFT JOIN (SELECT len(list_filter(e, lambda x: x <= {f})) AS b, sum({kind}) AS w FROM rw, fe_{f} GROUP BY 1) rb ON bins.b = rb.b
LEFT JOIN (SELECT len(list_filter(e, lambda x: x <= {f})) AS b, count(*) AS n FROM c, fe_{f} GROUP BY 1) cb ON bins.b = cb.b)"""
            )
    ctes = ", ".join(f"fe_{f} AS (SELECT list_sort(list_distinct(quantile_cont({f}, [{edges}]))) AS e FROM r)" for f in FEATURES)
    return f"WITH {sides}, {ctes}, d AS ({' UNION ALL '.join(part)})"


def sides(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").withColumn("age", ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("double"))
    return lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag <> 'R'")


@query("psi_drift", _drift_sql(False) + " SELECT feature, round(v, 6) AS psi FROM d")
def _(spark, sf_dir):
    return drift.psi(*sides(spark, sf_dir), FEATURES).select("feature", F.round("psi", 6).alias("psi"))


@query("psi_age_matched", _drift_sql(True) + " SELECT feature, round(v, 6) AS psi_age_matched FROM d WHERE kind = 'weight'")
def _(spark, sf_dir):
    r, c = sides(spark, sf_dir)
    out = drift.psi(drift.with_age_weights(r, c, "age"), c, FEATURES, weight="age_weight")
    return out.select("feature", F.round("psi", 6).alias("psi_age_matched"))


@query(
    "drift_report",
    _drift_sql(True)
    + " SELECT feature, round(max(v) FILTER (kind = '1'), 6) AS psi, round(max(v) FILTER (kind = 'weight'), 6) AS psi_age_matched, any_value(rm) AS reference_mean, any_value(rn) AS reference_rows, any_value(cm) AS current_mean, any_value(cn) AS current_rows FROM d JOIN ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, (SELECT round(avg({f}), 5) FROM r) AS rm, (SELECT count(*) FROM r) AS rn, (SELECT round(avg({f}), 5) FROM c) AS cm, (SELECT count(*) FROM c) AS cn" for f in FEATURES)
    + ") USING (feature) GROUP BY feature",
)
def _(spark, sf_dir):
    r, c = sides(spark, sf_dir)
    out = drift.drift(r, c, FEATURES, "age")
    return out.select("feature", *(F.round(x, 6).alias(x) for x in ("psi", "psi_age_matched")), F.round("reference_mean", 5).alias("reference_mean"), "reference_rows", F.round("current_mean", 5).alias("current_mean"), "current_rows")


# Snapshots: one per shipping month of performance by segment, and one of a drift value by feature.
def snapshots(spark, sf_dir):
    monthly = performance(spark, sf_dir, "month").select("segment", "rmse", F.to_timestamp(F.concat("month", F.lit("-01"))).alias("computed_at"))
    lines = load(spark, sf_dir, "lineitem")
    by_month = F.to_timestamp(F.date_format("l_shipdate", "yyyy-MM-01")).alias("computed_at")
    each = drift.unpivot(lines.withColumn("computed_at", by_month), FEATURES, ["computed_at"])
    return monthly, each.groupBy("feature", "computed_at").agg(F.abs(F.avg("value") / F.max("value") - 0.5).alias("psi_age_matched"))


SNAPSHOTS = f"""{PREDICTED}, {SEGMENTS}, perf AS (SELECT segment, month || '-01' AS computed_at, sqrt(avg((predicted - actual) ** 2)) AS rmse, count(*) AS n FROM s GROUP BY ALL),
dr AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, strftime(l_shipdate, '%Y-%m-01') AS computed_at, abs(avg({f}) / max({f}) - 0.5) AS psi FROM lineitem GROUP BY computed_at" for f in FEATURES)})"""


@query(
    "alert_checks",
    f"""WITH {SNAPSHOTS}, checks AS (
SELECT 'snapshot_age_hours' AS "check", 'performance' AS subject, date_diff('second', (SELECT max(computed_at) FROM perf)::TIMESTAMP, TIMESTAMP '2001-12-01') / 3600.0 AS value, 48.0 AS threshold
UNION ALL SELECT 'snapshot_age_hours', 'drift', date_diff('second', (SELECT max(computed_at) FROM dr)::TIMESTAMP, TIMESTAMP '2001-12-01') / 3600.0, 48.0
UNION ALL SELECT 'rmse_increase', segment, max_by(rmse, computed_at) / min_by(rmse, computed_at) - 1, 0.1 FROM perf WHERE segment IN ('endpoint', 'actual_le_50') GROUP BY segment
UNION ALL SELECT 'rmse_increase', 'never_seen', 'NaN'::DOUBLE, 0.1
UNION ALL SELECT 'psi_age_matched', feature, psi, 0.2 FROM dr WHERE computed_at = (SELECT max(computed_at) FROM dr))
SELECT "check", subject, round(value, 5) AS value, threshold::DOUBLE AS threshold, value > threshold AS breached FROM checks""",
)
def _(spark, sf_dir):
    perf, dr = snapshots(spark, sf_dir)
    now = F.to_timestamp(F.lit("2001-12-01 00:00:00"))
    out = drift.alert_checks(perf, dr, now, ["endpoint", "actual_le_50", "never_seen"], 0.1, 0.2, 48)
    return out.select("check", "subject", F.round("value", 5).alias("value"), "threshold", "breached")


@query(
    "first_last_snapshot",
    f"WITH {SNAPSHOTS} SELECT segment, round(min_by(rmse, computed_at), 5) AS first_rmse, round(max_by(rmse, computed_at), 5) AS last_rmse, count(*) AS snapshots FROM perf GROUP BY segment",
)
def _(spark, sf_dir):
    perf, _ = snapshots(spark, sf_dir)
    return perf.groupBy("segment").agg(F.round(F.min_by("rmse", "computed_at"), 5).alias("first_rmse"), F.round(F.max_by("rmse", "computed_at"), 5).alias("last_rmse"), F.count(F.lit(1)).alias("snapshots"))


@query("latest_snapshot", f"WITH {SNAPSHOTS} SELECT segment, n AS rows, round(rmse, 5) AS rmse FROM perf WHERE computed_at = (SELECT max(computed_at) FROM perf)")
def _(spark, sf_dir):
    perf = performance(spark, sf_dir, "month")
    return bi.latest(perf, "month").select("segment", "rows", F.round("rmse", 5).alias("rmse"))


# Price lists with validity: each ship mode of a month has its rate, the last one open-ended.
PRICES = """pr AS (SELECT y.y AS sku, q.q AS rate_no, make_timestamp(1995 + q.q * 2, 1, 1, 0, 0, 0) AS valid_from, CASE WHEN q.q < 3 THEN make_timestamp(1997 + q.q * 2, 1, 1, 0, 0, 0) END AS valid_to, 0.5 + q.q * 0.3 AS price
  FROM (VALUES ('F'), ('O'), ('P')) y(y), (VALUES (0), (1), (2), (3)) q(q))"""


def prices(spark):
    rows = [(s, q) for s in "FOP" for q in range(4)]
    df = spark.createDataFrame(rows, "sku string, rate_no int")
    return df.selectExpr("sku", "make_timestamp_ntz(1995 + rate_no * 2, 1, 1, 0, 0, 0) AS valid_from", "CASE WHEN rate_no < 3 THEN make_timestamp_ntz(1997 + rate_no * 2, 1, 1, 0, 0, 0) END AS valid_to", "0.5D + rate_no * 0.3D AS price")


@query(
    "price_validity_join",
    f"""WITH {PRICES} SELECT o_orderstatus AS sku, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, round(sum(o_totalprice), 2) AS units, round(sum(o_totalprice * price), 3) AS cost
FROM orders JOIN pr ON o_orderstatus = sku AND o_orderdate >= valid_from AND (o_orderdate + INTERVAL 36 HOURS <= valid_to OR valid_to IS NULL) GROUP BY ALL""",
)
def _(spark, sf_dir):
    # The price list has few rows and is below any broadcast limit; the planner decides by its size.
    orders = load(spark, sf_dir, "orders").withColumns({"sku": F.col("o_orderstatus"), "started": F.col("o_orderdate"), "ended": F.expr("o_orderdate + INTERVAL 36 HOURS")})
    joined = orders.alias("u").join(prices(spark).alias("p"), bi.price_holds()).select("u.*", "p.price")
    return joined.groupBy("sku", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("units"), F.round(F.sum(F.col("o_totalprice") * F.col("price")), 3).alias("cost"))


# Usage by line item: the day it ships, the supplier as the job, the status of its order as what is paid for.
@query(
    "cost_review",
    f"""WITH {PRICES}, u AS (SELECT l_shipdate::DATE AS usage_date, l_suppkey AS job_id, o_orderstatus AS sku, l_quantity AS units, l_shipdate AS started, l_shipdate + INTERVAL 1 DAY AS ended FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT CAST(usage_date AS VARCHAR) AS usage_date, job_id, u.sku, round(sum(units), 3) AS units, round(sum(units * price), 4) AS cost FROM u JOIN pr ON u.sku = pr.sku AND started >= valid_from AND (ended <= valid_to OR valid_to IS NULL)
WHERE usage_date >= DATE '2001-06-01' - INTERVAL 7 DAYS AND usage_date <= DATE '2001-06-01' GROUP BY ALL""",
)
def _(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("sku")), "l_orderkey")
    usage = lines.select(F.to_date("l_shipdate").alias("usage_date"), F.col("l_suppkey").alias("job_id"), "sku", F.col("l_quantity").alias("units"), F.col("l_shipdate").alias("started"), F.expr("l_shipdate + INTERVAL 1 DAY").alias("ended"))
    out = bi.cost_review(usage, prices(spark), ["usage_date", "job_id", "sku"], F.to_date(F.lit("2001-06-01")), days=7)
    return out.select(F.col("usage_date").cast("string").alias("usage_date"), "job_id", "sku", F.round("units", 3).alias("units"), F.round("cost", 4).alias("cost"))


# ---- merges: a target of most customers, changes for some --------------------------------------------------------

TARGET = "t AS (SELECT c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer WHERE c_custkey % 5 <> 0)"
CHANGES = "ch AS (SELECT c_custkey AS id, 'CHANGED' AS segment, c_acctbal + 1 AS balance FROM customer WHERE c_custkey % 4 = 0)"


def merge_sides(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    target = c.filter("c_custkey % 5 <> 0").selectExpr("c_custkey AS id", "c_mktsegment AS segment", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance")
    changes = c.filter("c_custkey % 4 = 0").selectExpr("c_custkey AS id", "'CHANGED' AS segment", "c_acctbal + 1 AS balance")
    return target, changes


@query("upsert_insert_only", f"WITH {TARGET}, {CHANGES} SELECT * FROM t UNION ALL SELECT * FROM ch WHERE id NOT IN (SELECT id FROM t)")
def _(spark, sf_dir):
    target, changes = merge_sides(spark, sf_dir)
    return target.unionByName(upsert.insert_only(target, changes, ["id"]))


@query("upsert_all", f"WITH {TARGET}, {CHANGES} SELECT * FROM ch UNION ALL SELECT * FROM t WHERE id NOT IN (SELECT id FROM ch)")
def _(spark, sf_dir):
    return upsert.upsert(*merge_sides(spark, sf_dir), ["id"])


@query(
    "scd_null_update",
    f"""WITH {TARGET}, {CHANGES} SELECT t.id, t.segment, coalesce(t.balance, ch.balance) AS balance, CASE WHEN t.balance IS NULL AND ch.balance IS NOT NULL THEN 'filled' ELSE 'as before' END AS note FROM t LEFT JOIN ch ON t.id = ch.id""",
)
def _(spark, sf_dir):
    target, changes = merge_sides(spark, sf_dir)
    return upsert.fill_where_null(target.withColumn("note", F.lit("as before")), changes, ["id"], "balance", "note", F.lit("filled"))


@query("orphan_delete", f"WITH {TARGET} SELECT * FROM t WHERE id IN (SELECT o_custkey FROM orders)")
def _(spark, sf_dir):
    target, _ = merge_sides(spark, sf_dir)
    return upsert.delete_orphans(target, load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), "id")


@query("stale_documents", "SELECT doc_id, sha256(text) AS text_hash FROM documents WHERE NOT (doc_id % 3 = 0 AND lang = 'en')")
def _(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_hash"), "lang")
    current = docs.filter("doc_id % 3 = 0 AND lang = 'en'")
    return upsert.stale_keys(docs.drop("lang"), current, ["doc_id", "text_hash"])


@query("orders_without_lines", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return load(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left_anti")
