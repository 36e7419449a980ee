"""Dashboard datasets, natural-language examples, gates and baselines over a derived fleet."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.catalog import load
from lodestone.operators import bi, boosting, gates
from lodestone.operators.features import with_cycle
from lodestone.operators.metrics import asymmetric_penalty
from lodestone.plans.registry import query

# The fleet: users are units; a prediction of remaining cycles for each cycle, by two model versions.
FLEET = """c AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle FROM events),
log AS (SELECT user_id, cycle, CASE WHEN user_id % 3 = 0 THEN '2' ELSE '3' END AS model_version, value / 2 AS predicted FROM c),
ends AS (SELECT user_id, max(cycle) AS last_cycle FROM c GROUP BY user_id),
status AS (SELECT log.user_id, last_cycle, model_version, predicted, CASE WHEN predicted <= 20 THEN 'critical' WHEN predicted <= 50 THEN 'warning' ELSE 'healthy' END AS risk_band FROM ends JOIN log ON log.user_id = ends.user_id AND log.cycle = last_cycle)"""


def predictions(spark, sf_dir):
    c = with_cycle(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])
    return c.select("user_id", "cycle", F.when(F.col("user_id") % 3 == 0, "2").otherwise("3").alias("model_version"), (F.col("value") / 2).alias("predicted"))


def status(spark, sf_dir):
    log = predictions(spark, sf_dir)
    ends = log.groupBy("user_id").agg(F.max("cycle").alias("last_cycle"))
    return bi.fleet_status(log, ends, ["user_id"], "cycle", "last_cycle", "predicted")


@query("risk_status", f"WITH {FLEET} SELECT user_id, last_cycle, model_version, round(predicted, 1) AS predicted, risk_band FROM status")
def _(spark, sf_dir):
    return status(spark, sf_dir).select("user_id", "last_cycle", "model_version", F.round("predicted", 1).alias("predicted"), "risk_band")


@query(
    "fleet_kpis",
    f"""WITH {FLEET} SELECT (SELECT count(*) FROM status) AS units, (SELECT count(*) FROM status WHERE risk_band = 'critical') AS critical, (SELECT count(*) FROM status WHERE risk_band = 'warning') AS warning,
(SELECT max(model_version) FROM log) AS model_version, (SELECT max_by(predicted, (cycle, user_id)) FROM log WHERE model_version = (SELECT max(model_version) FROM log)) AS newest_prediction, (SELECT round(avg(predicted), 4) FROM status) AS mean_remaining""",
)
def _(spark, sf_dir):
    log, fleet = predictions(spark, sf_dir), status(spark, sf_dir)
    kpis = bi.risk_kpis(fleet, "predicted").select("units", "critical", "warning", F.round("mean_remaining", 4).alias("mean_remaining"))
    newest = log.groupBy("model_version").agg(F.max_by("predicted", F.struct("cycle", "user_id")).alias("newest_prediction")).agg(F.max("model_version").alias("model_version"), F.max_by("newest_prediction", "model_version").alias("newest_prediction"))
    return kpis.join(newest)  # one row each


@query(
    "at_risk_trajectories",
    f"""WITH {FLEET}, worst AS (SELECT user_id FROM status ORDER BY predicted, user_id LIMIT 5)
SELECT 'Unit ' || lpad(CAST(log.user_id AS VARCHAR), 3, '0') AS unit, cycle, predicted FROM log JOIN worst USING (user_id)""",
)
def _(spark, sf_dir):
    log = predictions(spark, sf_dir)
    worst = status(spark, sf_dir).orderBy("predicted", "user_id").limit(5).select("user_id")
    return log.join(worst, "user_id").select(F.concat(F.lit("Unit "), F.lpad(F.col("user_id").cast("string"), 3, "0")).alias("unit"), "cycle", "predicted")


@query(
    "latest_performance",
    f"""WITH {FLEET}, e AS (SELECT model_version, cycle % 7 AS snapshot, predicted - 40 AS e FROM log)
SELECT model_version, snapshot, count(*) AS rows, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(avg(e), 6) AS bias FROM e WHERE snapshot = (SELECT max(snapshot) FROM e) AND model_version = (SELECT max(model_version) FROM e) GROUP BY ALL""",
)
def _(spark, sf_dir):
    e = predictions(spark, sf_dir).select("model_version", (F.col("cycle") % 7).alias("snapshot"), (F.col("predicted") - 40).alias("e"))
    newest = bi.latest(bi.latest(e, "model_version"), "snapshot")
    return newest.groupBy("model_version", "snapshot").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), 6).alias("rmse"), F.round(F.avg(F.abs("e")), 6).alias("mae"), F.round(F.avg("e"), 6).alias("bias")
    )


@query("latest_per_version", f"WITH {FLEET} SELECT model_version, user_id, predicted FROM log WHERE cycle = (SELECT max(cycle) FROM log l WHERE l.model_version = log.model_version)")
def _(spark, sf_dir):
    return bi.latest(predictions(spark, sf_dir), "cycle", ["model_version"]).select("model_version", "user_id", "predicted")


@query(
    "latest_drift",
    "WITH d AS (SELECT event_type AS feature, dayofmonth(ts) AS snapshot, avg(value) / 100 AS psi FROM events GROUP BY ALL) SELECT feature, round(psi, 6) AS psi, psi > 0.5 AS high FROM d WHERE snapshot = (SELECT max(snapshot) FROM d) ORDER BY psi DESC",
)
def _(spark, sf_dir):
    d = load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("feature"), F.dayofmonth("ts").alias("snapshot")).agg((F.avg("value") / 100).alias("psi"))
    return bi.latest(d, "snapshot").select("feature", F.round("psi", 6).alias("psi"), (F.col("psi") > 0.5).alias("high")).orderBy(F.desc("psi"))


@query(
    "alert_runs",
    """WITH a AS (SELECT dayofmonth(ts) AS run, event_type AS subject, value, value > 60 AS breached FROM events)
SELECT run, count(*) AS checks, count(*) FILTER (breached) AS breached, max(CASE WHEN subject = 'purchase' THEN value END) AS worst_purchase, max(CASE WHEN subject = 'view' THEN value END) AS worst_view FROM a GROUP BY run""",
)
def _(spark, sf_dir):
    a = load(spark, sf_dir, "events").select(F.dayofmonth("ts").alias("run"), F.col("event_type").alias("subject"), "value", (F.col("value") > 60).alias("breached"))
    worst = lambda s: F.max(F.when(F.col("subject") == s, F.col("value"))).alias(f"worst_{s}")
    return a.groupBy("run").agg(F.count(F.lit(1)).alias("checks"), F.count_if("breached").alias("breached"), worst("purchase"), worst("view"))


@query("worst_check_per_run", "SELECT dayofmonth(ts) AS run, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY dayofmonth(ts) ORDER BY value DESC, event_id) = 1")
def _(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(F.dayofmonth("ts").alias("run"), "event_id", "value")
    best = F.max_by(F.struct("event_id", "value"), F.struct("value", -F.col("event_id"))).alias("b")
    return e.groupBy("run").agg(best).select("run", "b.event_id", "b.value")


@query("checks_per_run", "SELECT dayofmonth(ts) AS run, count(*) AS checks FROM events GROUP BY 1 ORDER BY checks DESC, run")
def _(spark, sf_dir):
    return load(spark, sf_dir, "events").groupBy(F.dayofmonth("ts").alias("run")).agg(F.count(F.lit(1)).alias("checks")).orderBy(F.desc("checks"), "run")


@query(
    "regroup",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'pressing' WHEN o_orderpriority IN ('3-MEDIUM') THEN 'medium' ELSE 'later' END AS priority_group, CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS large,
coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END, 'Unspecified') AS status FROM orders""",
)
def _(spark, sf_dir):
    p = F.col("o_orderpriority")
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(p.isin("1-URGENT", "2-HIGH"), "pressing").when(p.isin("3-MEDIUM"), "medium").otherwise("later").alias("priority_group"),
        F.when(F.col("o_totalprice") > 100000, 1).otherwise(0).alias("large"),
        F.coalesce(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")), F.lit("Unspecified")).alias("status"),
    )


@query("by_prefix", "SELECT c_mktsegment AS segment, count(*) AS customers FROM customer WHERE CAST(c_custkey AS VARCHAR) LIKE '11%' GROUP BY 1 ORDER BY customers DESC, segment")
def _(spark, sf_dir):
    c = load(spark, sf_dir, "customer").filter(F.col("c_custkey").cast("string").like("11%"))
    return c.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "segment")


@query("widget_aggregates", "SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS orders, round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS highest, round(avg(o_totalprice), 4) AS mean FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1")
def _(spark, sf_dir):
    return widget(load(spark, sf_dir, "orders"), statuses=["F", "O"], since="1996-01-01")


def widget(orders, statuses, since):
    """A dashboard chart with its interactive filters as parameters."""
    o = orders.filter(F.col("o_orderstatus").isin(statuses) & (F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz")))
    month = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM").alias("month")
    return o.groupBy(month).agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_totalprice").alias("highest"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query("top_counts", "SELECT o_orderpriority AS priority, count(*) AS orders FROM orders GROUP BY 1 ORDER BY orders DESC, priority LIMIT 3")
def _(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("orders")).orderBy(F.desc("orders"), "priority").limit(3)


@query("widest_errors", f"WITH {FLEET} SELECT user_id, cycle, round(abs(predicted - 40), 6) AS error FROM log ORDER BY abs(predicted - 40) DESC, user_id, cycle LIMIT 10")
def _(spark, sf_dir):
    gap = F.abs(F.col("predicted") - 40)
    return predictions(spark, sf_dir).orderBy(gap.desc(), "user_id", "cycle").limit(10).select("user_id", "cycle", F.round(gap, 6).alias("error"))


@query("order_rollup", "SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS orders FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def _(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return o.rollup("status", "priority").agg(F.count(F.lit(1)).alias("orders"))


# A dataset for each nation: it may read a table that it must not, name a column that it must not, or lack what a widget shows.
@query(
    "dataset_lint",
    """SELECT n_nationkey AS id, concat_ws('; ', CASE WHEN n_nationkey % 2 = 1 THEN 'reads raw.table' || n_nationkey END, CASE WHEN n_nationkey % 3 = 1 THEN 'names ssn' END, CASE WHEN n_nationkey % 5 = 1 THEN 'lacks total' END) AS problems FROM nation""",
)
def _(spark, sf_dir):
    def problems(i):
        sql = f"WITH own{i} AS (SELECT * FROM orders WHERE note <> 'from hidden.table') SELECT {'SSN' if i % 3 == 1 else 'ssnx'}, count(*) AS n FROM own{i} JOIN {f'raw.table{i}' if i % 2 else 'customer'} c ON true"
        return "; ".join(bi.lint(spark, sql, {"orders", "customer"}, ["ssn"], ["total", "n"], ["n"] if i % 5 == 1 else ["n", "total"]))

    # A definition for each nation, of which there are 25.
    keys = [r[0] for r in load(spark, sf_dir, "nation").select("n_nationkey").collect()]
    return spark.createDataFrame([(k, problems(k)) for k in keys], "id int, problems string")


# ---- questions in SQL over the marts -----------------------------------------------------------------------------

MARTS_SQL = f"""{FLEET}, perf AS (SELECT model_version, segment, snapshot, count(*) AS rows, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(e) AS bias FROM (SELECT model_version, 'all' AS segment, cycle % 7 AS snapshot, predicted - 40 AS e FROM log
  UNION ALL SELECT model_version, 'endpoint', cycle % 7, predicted - 40 FROM log JOIN ends ON ends.user_id = log.user_id AND last_cycle = cycle) GROUP BY ALL),
drifts AS (SELECT event_type AS feature, dayofmonth(ts) AS snapshot, avg(value) / 100 AS psi, avg(value) / 100 - max(CASE WHEN event_type < 'p' THEN 0.2 ELSE 0.1 END) AS psi_age_matched FROM events GROUP BY ALL),
reports AS (SELECT year(o_orderdate) AS event_year, o_orderpriority AS source_category, CAST(o_custkey AS VARCHAR) AS naics, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 3 END AS amputation FROM orders),
alerts AS (SELECT dayofmonth(ts) AS run, event_type AS "check", ts AS checked_at, value > 60 AS breached, 60.0 AS threshold FROM events)"""


def marts(spark, sf_dir):
    """The marts that questions are about, each over a whole table."""
    log, events, orders = predictions(spark, sf_dir), load(spark, sf_dir, "events"), load(spark, sf_dir, "orders")
    ends = log.groupBy("user_id").agg(F.max("cycle").alias("cycle"))
    e = log.select("user_id", "cycle", "model_version", (F.col("cycle") % 7).alias("snapshot"), (F.col("predicted") - 40).alias("e"))
    e = e.withColumn("segment", F.lit("all")).unionByName(e.join(ends, ["user_id", "cycle"], "left_semi").withColumn("segment", F.lit("endpoint")))
    o, value = F.col("o_orderkey"), F.avg("value") / 100
    return {
        "fleet_status": status(spark, sf_dir),
        "performance": e.groupBy("model_version", "segment", "snapshot").agg(F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), F.avg(F.abs("e")).alias("mae"), F.avg("e").alias("bias")),
        "feature_drift": events.groupBy(F.col("event_type").alias("feature"), F.dayofmonth("ts").alias("snapshot")).agg(value.alias("psi"), (value - F.when(F.col("event_type") < "p", 0.2).otherwise(0.1)).alias("psi_age_matched")),
        "injury_facts": orders.select(F.year("o_orderdate").alias("event_year"), F.col("o_orderpriority").alias("source_category"), F.col("o_custkey").cast("string").alias("naics"), F.when(o % 7 != 0, o % 3).alias("amputation")),
        "alerts": events.select(F.dayofmonth("ts").alias("run"), F.col("event_type").alias("check"), F.col("ts").alias("checked_at"), (F.col("value") > 60).alias("breached"), F.lit(60.0).alias("threshold")),
    }


#: Each question: its SQL over the marts, the values that it is asked with, and plain SQL for comparison.
QUESTIONS = {
    "ask_failing_units": (
        "SELECT user_id, last_cycle, round(predicted, 1) AS predicted, risk_band FROM {fleet_status} WHERE predicted <= :cycles ORDER BY predicted, user_id",
        {"cycles": 20},
        "SELECT user_id, last_cycle, round(predicted, 1) AS predicted, risk_band FROM status WHERE predicted <= 20",
    ),
    "ask_latest_endpoint": (
        "SELECT model_version, snapshot, rows, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(bias, 6) AS bias FROM {performance} WHERE segment = :segment AND model_version = (SELECT max(model_version) FROM {fleet_status}) ORDER BY snapshot DESC LIMIT 1",
        {"segment": "endpoint"},
        "SELECT model_version, snapshot, rows, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(bias, 6) AS bias FROM perf WHERE segment = 'endpoint' AND model_version = (SELECT max(model_version) FROM status) ORDER BY snapshot DESC LIMIT 1",
    ),
    "ask_drifting_features": (
        "SELECT feature, round(psi_age_matched, 6) AS psi_age_matched, round(psi, 6) AS raw_psi FROM {feature_drift} WHERE snapshot = (SELECT max(snapshot) FROM {feature_drift}) ORDER BY psi_age_matched DESC, feature LIMIT 10",
        {},
        "SELECT feature, round(psi_age_matched, 6) AS psi_age_matched, round(psi, 6) AS raw_psi FROM drifts WHERE snapshot = (SELECT max(snapshot) FROM drifts)",
    ),
    "ask_yearly_amputations": (
        "SELECT event_year, count(*) AS reports FROM {injury_facts} WHERE amputation > :least GROUP BY event_year ORDER BY event_year",
        {"least": 0},
        "SELECT event_year, count(*) AS reports FROM reports WHERE amputation > 0 GROUP BY event_year",
    ),
    "ask_common_sources": (
        "SELECT source_category, count(*) AS reports FROM {injury_facts} WHERE startswith(naics, :industry) GROUP BY source_category ORDER BY reports DESC, source_category",
        {"industry": "11"},
        "SELECT source_category, count(*) AS reports FROM reports WHERE naics LIKE '11%' GROUP BY source_category",
    ),
    "ask_last_alerts": (
        "SELECT run, `check`, count(*) AS checks, count_if(breached) AS breaches, max(threshold) AS threshold FROM {alerts} WHERE run = (SELECT max_by(run, checked_at) FROM {alerts}) GROUP BY run, `check` ORDER BY `check`",
        {},
        'SELECT run, "check", count(*) AS checks, count(*) FILTER (breached) AS breaches, max(threshold) AS threshold FROM alerts WHERE run = (SELECT max_by(run, checked_at) FROM alerts) GROUP BY ALL',
    ),
}


def _question(name):
    text, values, _ = QUESTIONS[name]
    return lambda spark, sf_dir: bi.ask(spark, text, marts(spark, sf_dir), **values)


for _name, (_, _, _sql) in QUESTIONS.items():
    query(_name, f"WITH {MARTS_SQL} {_sql}")(_question(_name))


# ---- gates -----------------------------------------------------------------------------------------------------

EVIDENCE = """e AS (SELECT n_nationkey AS id, 'v' || n_nationkey AS version, CASE WHEN n_nationkey % 4 = 0 THEN 'csv' ELSE 'gold' END AS source, 10.0 + n_nationkey AS rmse, CASE WHEN n_nationkey % 5 = 0 THEN 'other' ELSE 'same' END AS digest FROM nation)"""


@query(
    "promotion_reasons",
    f"""WITH {EVIDENCE} SELECT id, concat_ws(', ', CASE WHEN source <> 'gold' THEN 'training source' END, CASE WHEN NOT rmse <= 0.5 * 50 THEN 'baseline' END,
CASE WHEN version = 'v12' THEN 'already champion' WHEN digest <> 'same' THEN 'not comparable' WHEN NOT rmse <= 22.0 THEN 'worse than champion' END) AS reasons FROM e""",
)
def _(spark, sf_dir):
    n = F.col("n_nationkey")
    evidence = lambda version, source, rmse, digest: F.struct(
        version.alias("version"), F.lit("FD001").alias("subset"), source.alias("training_source"), F.array(F.lit("a"), F.lit("b")).alias("input_columns"), rmse.alias("validation_rmse"), F.array(F.lit(1), F.lit(2)).alias("validation_units"), digest.alias("labels_digest")
    )
    own = evidence(F.concat(F.lit("v"), n.cast("string")), F.when(n % 4 == 0, "csv").otherwise("gold"), n + 10.0, F.when(n % 5 == 0, "other").otherwise("same"))
    champion = evidence(F.lit("v12"), F.lit("gold"), F.lit(22.0), F.lit("same"))
    e = load(spark, sf_dir, "nation").select(n.alias("id"), own.alias("challenger"), champion.alias("champion"), F.lit(50.0).alias("baseline"))
    return e.select("id", F.array_join(gates.promotion_reasons("challenger", "champion", "baseline", "gold", ["a", "b"]), ", ").alias("reasons"))


# Inputs of training and their digests: those of nations, of which the champion had other ones, or lacked some, or had more.
DIGESTS = """now AS (SELECT 'input ' || n_nationkey AS name, md5(n_name) AS digest FROM nation WHERE n_nationkey % 7 <> 3), used AS (SELECT 'input ' || n_nationkey AS name, CASE WHEN n_nationkey % 6 = 1 THEN md5('other') ELSE md5(n_name) END AS digest FROM nation WHERE n_nationkey % 5 <> 2)"""


@query(
    "retrain_reason",
    f"""WITH {DIGESTS}, d AS (SELECT now.name FROM now LEFT JOIN used ON now.name = used.name WHERE now.digest IS DISTINCT FROM used.digest)
SELECT count(*) > 0 AS retrain, CASE WHEN count(*) > 0 THEN 'changed: ' || string_agg(name, ', ' ORDER BY name) ELSE 'unchanged' END AS reason FROM d""",
)
def _(spark, sf_dir):
    key, name = F.col("n_nationkey"), F.concat(F.lit("input "), F.col("n_nationkey").cast("string")).alias("name")
    nations = load(spark, sf_dir, "nation")
    now = nations.filter(key % 7 != 3).select(name, F.md5("n_name").alias("digest"))
    used = nations.filter(key % 5 != 2).select(name, F.md5(F.when(key % 6 == 1, F.lit("other")).otherwise(F.col("n_name"))).alias("digest"))
    return gates.retrain_reason(now, used)


@query(
    "constant_baseline",
    """WITH e AS (SELECT value, CAST(('0x' || left(sha256('42:' || user_id), 8)) AS BIGINT) % 1000 < 200 AS v FROM events), m AS (SELECT avg(value) AS m FROM e WHERE NOT v)
SELECT round((SELECT m FROM m), 6) AS mean, round(sqrt(avg((value - (SELECT m FROM m)) ** 2)), 6) AS rmse FROM e WHERE v""",
)
def _(spark, sf_dir):
    out = gates.constant_baseline(load(spark, sf_dir, "events"), gates.group_split(F.col("user_id")), "value")
    return out.select(F.round("mean", 6).alias("mean"), F.round("rmse", 6).alias("rmse"))


@query("gbt_score")
def _(spark, sf_dir):
    from lodestone.operators.features import causal_features, countdown_label

    rows = countdown_label(causal_features(with_cycle(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]), "user_id", "cycle", ["value"]), "user_id", "cycle")
    held = gates.group_split(F.col("user_id"))
    features = ["cycle", "value", "value_mean_10", "value_delta_5"]
    model, _ = boosting.grid_search(rows, held, features, "rul")
    return model.transform(rows).select("event_id", "user_id", "cycle", "rul", F.round("prediction", 6).alias("predicted"))


@query("segment_score", f"WITH {FLEET}, e AS (SELECT model_version, (predicted - 40) / 10 AS e FROM log) SELECT model_version, round(sum(CASE WHEN e < 0 THEN exp(-e / 13) - 1 ELSE exp(e / 10) - 1 END), 4) AS score FROM e GROUP BY model_version")
def _(spark, sf_dir):
    e = predictions(spark, sf_dir).select("model_version", ((F.col("predicted") - 40) / 10).alias("e"))
    return e.groupBy("model_version").agg(F.round(F.sum(asymmetric_penalty(F.col("e"))), 4).alias("score"))
