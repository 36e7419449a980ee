"""Parsing, validation of nested responses, streaming runs, request plans and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestone import functions as fn
from lodestone.catalog import load, run_dir, shared_dir, stage
from lodestone.operators.expect import REPORT_RULES, WEATHER_SERIES, event_rules, weather_rules
from lodestone.plans.events_plans import produced
from lodestone.plans.registry import query
from lodestone.sources import files, pacing, sinks
from lodestone.streaming import ingest, replay


@query(
    "positional_tokens",
    """SELECT l_orderkey, l_linenumber, l_quantity AS t1, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS t2, CAST(NULL AS DOUBLE) AS t9, CASE WHEN l_orderkey % 7 = 0 THEN 3 ELSE 3 END AS width, l_linenumber = floor(l_linenumber) AND l_linenumber BETWEEN 1 AND 2147483647 AS whole FROM lineitem""",
)
def _(spark, sf_dir):
    l = load(spark, sf_dir, "lineitem")
    raw = F.concat(F.lit("  "), F.col("l_quantity").cast("string"), F.lit("   "), F.when(F.col("l_orderkey") % 7 == 0, "bad").otherwise(F.col("l_discount").cast("string")), F.lit("\t"), F.col("l_linenumber").cast("string"), F.lit(" "))
    t = l.select("l_orderkey", "l_linenumber", fn.tokens(raw).alias("t"))
    third = fn.token_double(F.col("t"), 3)
    return t.select("l_orderkey", "l_linenumber", fn.token_double(F.col("t"), 1).alias("t1"), fn.token_double(F.col("t"), 2).alias("t2"), fn.token_double(F.col("t"), 9).alias("t9"), F.size("t").alias("width"), ((third == F.floor(third)) & third.between(1, 2147483647)).alias("whole"))


# Fixed value: how response files are named: model, state, city, first and last day.
FILE = r"^([a-z0-9]+)_([a-z-]+?)--([a-z-]+)_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]{4}-[0-9]{2}-[0-9]{2})[.]json$"


@query(
    "file_name_parts",
    """SELECT n_nationkey, CASE WHEN n_nationkey % 6 <> 0 THEN 'era5' END AS model, CASE WHEN n_nationkey % 6 <> 0 THEN 'state-' || chr(97 + n_nationkey) END AS state, CASE WHEN n_nationkey % 6 <> 0 THEN '366' END AS days, CASE WHEN n_nationkey % 6 <> 0 THEN upper('state-' || chr(97 + n_nationkey)) END AS shown FROM nation""",
)
def _(spark, sf_dir):
    name = F.concat(F.lit("state-"), F.char(97 + F.col("n_nationkey")))
    path = F.concat(F.lit("landing/daily/"), F.when(F.col("n_nationkey") % 6 == 0, "notes.txt").otherwise(F.concat(F.lit("era5_"), name, F.lit("--capital_2024-01-01_2024-12-31.json"))))
    parts = load(spark, sf_dir, "nation").select("n_nationkey", fn.file_name(path).alias("f"))
    get = lambda i: fn.matched(F.col("f"), FILE, i)
    return parts.select("n_nationkey", get(1).alias("model"), get(2).alias("state"), (F.datediff(fn.safe_date(get(5)), fn.safe_date(get(4))) + 1).cast("string").alias("days"), F.upper(get(2)).alias("shown"))


@query("slugs", "SELECT p_partkey, regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g') AS slug FROM part")
def _(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", fn.slug(F.col("p_name")).alias("slug"))


# Nested daily responses: one per user with its events' values by day of the month, some of them damaged.
SERIES = list(WEATHER_SERIES)


def responses(spark, sf_dir):
    days = load(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("v"))
    lists = days.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("day", "v"))).alias("d"))
    scaled = lambda k: F.transform("d", lambda x: x["v"] / 10 - k)
    whole = F.sequence(F.element_at("d", 1)["day"], F.element_at("d", -1)["day"])
    time = F.transform("d", lambda x: x["day"].cast("string"))
    return lists.select(
        "user_id",
        F.when(F.col("user_id") % 11 == 0, '{"extra": 1}').alias("rescued"),
        F.when(F.col("user_id") % 13 != 0, F.concat(F.lit("state--"), F.col("user_id").cast("string"))).alias("location_id"),
        F.struct(*(F.when(F.col("user_id") % 17 == 0, "°F").otherwise("°C").alias(s) for s in SERIES)).alias("daily_units"),
        F.when(F.col("user_id") % 19 != 0, F.struct(time.alias("time"), scaled(0).alias(SERIES[0]), scaled(1).alias(SERIES[1]), scaled(F.when(F.col("user_id") % 23 == 0, 200).otherwise(0.5)).alias(SERIES[2]))).alias("daily"),
        F.element_at(whole, 1).alias("window_start"),
        F.element_at(whole, -1).alias("window_end"),
    )


def response_days(spark, sf_dir):
    """A row for each day of a response, with its place; a response without days is one row without values."""
    read = responses(spark, sf_dir)
    rows = F.arrays_zip(*(F.col(f"daily.{c}").alias(c) for c in ("time", *SERIES)))
    days = read.select("*", F.posexplode_outer(rows).alias("i", "_day"))
    return days.select(*read.columns, "i", F.col("_day.time").alias("day"), fn.safe_date(F.col("_day.time")).alias("date"), *(F.col(f"_day.{s}").alias(s) for s in SERIES))


DAYS_SQL = """d AS (SELECT user_id, ts::DATE AS day, max(value) AS v FROM events GROUP BY ALL), w AS (SELECT user_id, min(day) AS lo, max(day) AS hi, count(*) AS n FROM d GROUP BY user_id),
x AS (SELECT d.user_id, day, v, lo, hi, n, row_number() OVER (PARTITION BY d.user_id ORDER BY day) - 1 AS i FROM d JOIN w ON d.user_id = w.user_id),
y AS (SELECT user_id, CASE WHEN user_id % 19 <> 0 THEN day END AS day, lo, hi, n, i, CASE WHEN user_id % 19 <> 0 THEN v END AS v FROM x WHERE user_id % 19 <> 0 OR i = 0),
f AS (SELECT user_id, day, concat_ws(',', CASE WHEN user_id % 11 = 0 THEN 'schema_conforms' END, CASE WHEN user_id % 13 = 0 THEN 'known_file_name' END, CASE WHEN user_id % 17 = 0 THEN 'celsius_units' END,
  CASE WHEN day IS NULL OR n <> hi - lo + 1 THEN 'complete_series' END, CASE WHEN day IS NULL OR day <> lo + i::INTEGER THEN 'date_matches_position' END, CASE WHEN v IS NULL THEN 'has_values' END,
  CASE WHEN v IS NULL OR NOT (v / 10 BETWEEN -60 AND 60 AND v / 10 - 1 BETWEEN -60 AND 60 AND v / 10 - (CASE WHEN user_id % 23 = 0 THEN 200 ELSE 0.5 END) BETWEEN -80 AND 75) THEN 'plausible_values' END,
  CASE WHEN v IS NULL OR NOT v / 10 - 1 <= v / 10 THEN 'mean_not_above_max' END) AS failed_rules FROM y)"""


@query("weather_days", f"WITH {DAYS_SQL} SELECT failed_rules, count(*) AS days, count(DISTINCT user_id) AS responses FROM f GROUP BY failed_rules")
def _(spark, sf_dir):
    checked = weather_rules().check(response_days(spark, sf_dir))
    return checked.groupBy(F.array_join("failed_rules", ",").alias("failed_rules")).agg(F.count(F.lit(1)).alias("days"), F.count_distinct("user_id").alias("responses"))


# Reports whose months, industries and codes lie on both sides of what the rules allow.
MONTHS = ["2024-05", "2024-13", "1999-05", "2024-00", "2031-12"]
INDUSTRIES = ["", "31-33", "311111", "311111-22", "abc", "3", "48-49", "1234567"]
CODES = ["12", None, "x1", ""]


@query(
    "report_rules",
    f"""WITH r AS (SELECT doc_id, {MONTHS}[doc_id % {len(MONTHS)} + 1] AS m, CASE WHEN doc_id % 7 = 0 THEN 'X' WHEN doc_id % 11 = 0 THEN NULL ELSE 'TX' END AS s, {INDUSTRIES}[doc_id % {len(INDUSTRIES)} + 1] AS n, doc_id % 4 = 1 AS uncoded, doc_id % 13 = 0 AS odd, text FROM documents)
SELECT doc_id, concat_ws(',', CASE WHEN NOT doc_id > 0 THEN 'positive_id' END, CASE WHEN odd THEN 'schema_conforms' END, CASE WHEN m NOT IN ('2024-05', '2031-12') THEN 'month_format' END, CASE WHEN s IS NULL OR length(s) <= 1 THEN 'state_present' END,
  CASE WHEN n IN ('311111-22', 'abc', '3', '1234567') THEN 'naics_format' END, CASE WHEN length(trim(text)) < 20 THEN 'narrative_present' END, CASE WHEN uncoded THEN 'event_coded' END) AS failed_rules FROM r""",
)
def _(spark, sf_dir):
    i = F.col("doc_id")
    one_of = lambda values: F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (i % len(values) + 1).cast("int"))
    r = load(spark, sf_dir, "documents").select(
        "doc_id",
        i.alias("report_id"),
        F.when(i % 13 == 0, '{"more":"1"}').alias("rescued"),
        one_of(MONTHS).alias("event_month"),
        F.when(i % 7 == 0, "X").when(i % 11 != 0, "TX").alias("state"),
        one_of(INDUSTRIES).alias("naics"),
        F.col("text").alias("narrative"),
        one_of(CODES).alias("event_code"),
    )
    return REPORT_RULES.check(r).select("doc_id", F.array_join("failed_rules", ",").alias("failed_rules"))


# Events of a fleet as JSON; some are no object, have a field too many, another id, or keys outside their domain.
DOMAINS = {"dataset": "^FLEET$", "subset": "^FD00[1-4]$", "split": "^(train|test)$"}


@query(
    "stream_events",
    """WITH c AS (SELECT user_id + 1 AS unit, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle FROM events),
d AS (SELECT *, cycle % 50 = 3 AS no_object, cycle % 50 = 7 AS odd, cycle % 50 = 11 AS other_id, cycle % 50 = 13 AS unknown_subset, cycle % 50 = 17 AS held, cycle % 50 = 19 AS none, cycle % 50 = 23 AS no_dataset FROM c)
SELECT unit, cycle, concat_ws(',', CASE WHEN no_object THEN 'is_json_object' END, CASE WHEN no_object OR odd OR no_dataset THEN 'exact_keys' END, CASE WHEN no_object OR unknown_subset OR held OR no_dataset THEN 'key_domain' END,
  CASE WHEN no_object OR other_id OR no_dataset THEN 'id_matches' END, CASE WHEN no_object OR none THEN 'finite_values' END) AS failed_rules FROM d""",
)
def _(spark, sf_dir):
    e, at = produced(spark, sf_dir).select("unit", "cycle", F.from_json("payload", "value DOUBLE")["value"].alias("v")), F.col("cycle") % 50
    subset, split = F.when(at == 13, "FD005").otherwise("FD002"), F.when(at == 17, "held").otherwise("test")
    key = F.format_string("%s-%s-%s-%03d-%03d", F.lit("FLEET"), subset, split, F.col("unit").cast("int"), F.col("cycle").cast("int"))
    fields = F.struct(
        F.when(at == 11, "other").otherwise(key).alias("event_id"), F.when(at != 23, F.lit("FLEET")).alias("dataset"), subset.alias("subset"), split.alias("split"), "unit", "cycle", F.when(at == 19, "NaN").alias("value"), F.when(at == 7, 1).alias("odd")
    )
    shown = F.regexp_replace(F.to_json(fields), r"\}$", F.when(at == 19, "}").otherwise(F.concat(F.lit(',"value":'), F.col("v").cast("string"), F.lit("}"))))
    parsed = e.select("unit", "cycle", F.when(at == 3, "[1]").otherwise(shown).alias("payload"))
    parsed = parsed.withColumn("event", F.from_json("payload", "event_id STRING, dataset STRING, subset STRING, split STRING, unit INT, cycle INT, value DOUBLE"))
    rules = event_rules("payload", ["dataset", "subset", "split", "unit", "cycle"], ["value"], "format_string('%s-%s-%s-%03d-%03d', event.dataset, event.subset, event.split, event.unit, event.cycle)", DOMAINS)
    return rules.check(parsed).select("unit", "cycle", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("request_plan", "SELECT n_nationkey, n_name, CAST(y.y AS INTEGER) AS year FROM nation, (SELECT unnest(range(2019, 2025)) AS y) y")
def _(spark, sf_dir):
    return pacing.request_plan(load(spark, sf_dir, "nation").select("n_nationkey", "n_name"), 2019, 2024, ["n_name"])


# A log of calls: each order asks for some days and variables of one to three places, at its date.
CALLS = "w AS (SELECT o_orderkey, o_custkey, o_orderdate AS called, (1 + o_orderkey % 3) * greatest(1.0, (1 + o_orderkey % 400) / 14.0) * greatest(1.0, (1 + o_orderkey % 25) / 10.0) AS weight FROM orders)"


def calls(spark, sf_dir):
    k = F.col("o_orderkey")
    weight = pacing.call_weights(1 + k % 400, 1 + k % 25, 1 + k % 3)
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("called"), weight.alias("weight"))


@query("call_weights", f"WITH {CALLS} SELECT o_orderkey, round(weight, 6) AS weight FROM w")
def _(spark, sf_dir):
    return calls(spark, sf_dir).select("o_orderkey", F.round("weight", 6).alias("weight"))


@query("call_budgets", f"WITH {CALLS} SELECT o_orderkey, round(sum(weight) OVER (PARTITION BY o_custkey ORDER BY epoch(called)::BIGINT RANGE BETWEEN 2591999 PRECEDING AND CURRENT ROW), 4) AS used FROM w")
def _(spark, sf_dir):
    used = pacing.budget_used(calls(spark, sf_dir), "called", "weight", 30 * 86400, "used", ["o_custkey"])
    return used.select("o_orderkey", F.round("used", 4).alias("used"))


@query(
    "calls_left",
    f"""WITH {CALLS} SELECT round(coalesce(sum(weight) FILTER (called <= TIMESTAMP '1998-01-01' AND called > TIMESTAMP '1997-12-25'), 0), 3) AS week, round(coalesce(sum(weight) FILTER (called <= TIMESTAMP '1998-01-01' AND called > TIMESTAMP '1996-12-27'), 0), 3) AS long FROM w""",
)
def _(spark, sf_dir):
    used = pacing.used_by_window(calls(spark, sf_dir), "called", "weight", F.lit("1998-01-01 00:00:00"), {"week": 7 * 86400, "long": 370 * 86400})
    return used.select(F.round("week", 3).alias("week"), F.round("long", 3).alias("long"))


@query("stream_rerun", "SELECT count(*) AS rows, count(DISTINCT event_id) AS events, 0 AS added_again FROM events")
def _(spark, sf_dir):
    """Events as a stream of files: a second run adds nothing, and a second flow adds its own source once."""
    root = f"{shared_dir(spark)}/lodestone/stream-{uuid.uuid4().hex}"
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "value")
    events.write.parquet(f"{root}/in/a")
    source = lambda: ingest.parquet_stream(spark, f"{root}/in/a", events.schema)
    added = [ingest.ingest(source(), f"{root}/bronze", f"{root}/cp") for _ in range(2)]
    return spark.read.parquet(f"{root}/bronze").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events")).withColumn("added_again", F.lit(added[1]))


@query(
    "replayed_log",
    """SELECT event_id, p AS partition, row_number() OVER (PARTITION BY p ORDER BY late, ts, event_id) - 1 AS "offset", 0 AS added_again
FROM (SELECT *, event_id % 5 = 0 AS late, CAST(((user_id - 1) % 4 + 4) % 4 AS INTEGER) AS p FROM events)""",
)
def _(spark, sf_dir):
    """Events as a log with offsets: a stream from its beginning, then what was appended meanwhile, then nothing."""
    root = f"{run_dir(spark)}/log-{uuid.uuid4().hex}"
    events = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late, place, added = F.col("event_id") % 5 == 0, fn.unit_partition(F.col("user_id"), 4), []
    for part in (events.filter(~late), events.filter(late), None):
        if part is not None:
            first = replay.next_offsets(f"{root}/log") if added else None
            key, body = F.col("user_id").cast("string"), F.to_json(F.struct("event_id", "user_id", "value"))
            replay.append_to_log(part, f"{root}/log", place, ["ts", "event_id"], key, body, "events", F.col("ts"), first)
        added.append(ingest.ingest(replay.log_stream(spark, f"{root}/log"), f"{root}/bronze", f"{root}/checkpoint"))
    event = F.get_json_object("payload", "$.event_id").cast("long").alias("event_id")
    return spark.read.parquet(f"{root}/bronze").select(event, "partition", "offset", F.lit(added[2]).alias("added_again"))


@query("landed_lines", "SELECT l_orderkey % 50 AS first, count(*) AS lines, count(DISTINCT l_orderkey) AS orders, CAST(sum(l_linenumber) AS BIGINT) AS numbers FROM lineitem GROUP BY 1")
def _(spark, sf_dir):
    root = f"{shared_dir(spark)}/lodestone/lines-{uuid.uuid4().hex}"
    l = load(spark, sf_dir, "lineitem")
    l.select(F.concat(F.lit(" "), F.concat_ws("  ", "l_orderkey", "l_linenumber"))).write.text(root)
    lines = files.text_lines(spark, root).withColumn("t", fn.tokens(F.col("raw_line")))
    key, number = (fn.token_double(F.col("t"), i).cast("long") for i in (1, 2))
    return lines.groupBy((key % 50).alias("first")).agg(F.count(F.lit(1)).alias("lines"), F.count_distinct(key).alias("orders"), F.sum(number).alias("numbers"))


@query(
    "ledger_run",
    "SELECT CAST(l_linenumber % 2 AS INTEGER) AS run, count(*) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS numbers, 0 AS added_again FROM lineitem GROUP BY 1",
)
def _(spark, sf_dir):
    """Lines that land in two runs, as a stream behind a ledger of files; a third run finds nothing new."""
    root, added = f"{run_dir(spark)}/ledger-{uuid.uuid4().hex}", []
    l = load(spark, sf_dir, "lineitem")
    for part in (l.filter("l_linenumber % 2 = 0"), l.filter("l_linenumber % 2 = 1"), None):
        if part is not None:
            part.select(F.concat_ws(" ", "l_orderkey", "l_linenumber")).write.mode("append").text(f"{root}/in")
        files.landed(spark, f"{root}/in", f"{root}/ledger")
        added.append(ingest.ingest(files.text_lines(spark, f"{root}/in", stream=True).select("raw_line"), f"{root}/bronze", f"{root}/checkpoint"))
    number = fn.token_double(fn.tokens(F.col("raw_line")), 2).cast("int")
    out = spark.read.parquet(f"{root}/bronze").groupBy((number % 2).alias("run"))
    return out.agg(F.count(F.lit(1)).alias("lines"), F.sum(number).alias("numbers")).withColumn("added_again", F.lit(added[2]))


# Lines of 26 tokens, some of them short, with words or numbers that aren't finite, or with keys that are no positive whole numbers.
@query(
    "trajectory_quality",
    """WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle FROM events),
f AS (SELECT concat_ws(',', CASE WHEN event_id % 7 = 1 THEN 'width' END, CASE WHEN event_id % 11 = 1 THEN 'subset' END, CASE WHEN event_id % 13 = 1 THEN 'split' END,
  CASE WHEN event_id % 17 = 1 OR cycle % 19 = 1 OR user_id < 1 THEN 'keys' END, CASE WHEN event_id % 7 = 1 OR event_id % 23 = 1 THEN 'finite' END) AS failed_rules FROM e)
SELECT failed_rules, count(*) AS lines FROM f GROUP BY 1""",
)
def _(spark, sf_dir):
    from lodestone.operators.expect import trajectory_rules
    from lodestone.operators.features import with_cycle

    i = F.col("event_id")
    unit = F.when(i % 17 == 1, F.lit("0")).otherwise(F.col("user_id").cast("string"))
    cycle = F.when(F.col("cycle") % 19 == 1, F.concat("cycle", F.lit(".5"))).otherwise(F.col("cycle").cast("string"))
    last = F.when(i % 23 == 1, F.element_at(F.array(F.lit("NaN"), F.lit("Infinity"), F.lit("x")), (i % 3 + 1).cast("int"))).otherwise(F.col("value").cast("string"))
    values = F.when(i % 7 == 1, F.array(last)).otherwise(F.concat(F.array_repeat(F.col("value").cast("string"), 23), F.array(last)))
    rows = with_cycle(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])
    lines = rows.select(F.array_join(F.concat(F.array(unit, cycle), values), "  ").alias("raw_line"), F.when(i % 11 == 1, "").otherwise("FD001").alias("subset"), F.when(i % 13 == 1, "held").otherwise("train").alias("split"))
    checked = trajectory_rules().check(files.parse_trajectory(lines))
    return checked.groupBy(F.array_join("failed_rules", ",").alias("failed_rules")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "recomputed_layers",
    "SELECT 'silver' AS layer, count(*) AS compared, 0 AS mismatches FROM orders UNION ALL SELECT 'gold', 3 * count(DISTINCT strftime(o_orderdate, '%Y-%m')), 0 FROM orders",
)
def _(spark, sf_dir):
    """Orders as raw JSON lines, refined and summed up again, against the stored table and its months."""
    from lodestone.operators import checks

    path = f"{run_dir(spark)}/raw-{uuid.uuid4().hex}"
    silver = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    silver.select(F.to_json(F.struct("*"))).write.text(path)
    refine = lambda raw: raw.select(F.from_json("raw_line", silver.schema).alias("r")).select("r.*")
    months = lambda rows: rows.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(checks.exact_mean("o_totalprice").alias("mean"), F.max("o_totalprice").alias("highest"), F.count(F.lit(1)).alias("orders"))
    numbers = ["mean", "highest", "orders"]
    gold = stage(months(silver), "months")
    return checks.recomputed(files.text_lines(spark, path), refine, silver, ["o_orderkey"], ["o_custkey", "o_totalprice", "o_orderdate"], months, gold, ["month"], numbers)


@query("rescued_json", """SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN '{"extra":"1"}' END AS rescued FROM nation""")
def _(spark, sf_dir):
    root = f"{shared_dir(spark)}/lodestone/json-{uuid.uuid4().hex}"
    extra = F.when(F.col("n_nationkey") % 3 == 0, 1).alias("extra")
    load(spark, sf_dir, "nation").select(F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), extra)).alias("value")).write.text(root)
    return files.json_lines(spark, root, "id INT, name STRING", pattern="*.txt").select("id", "name", "rescued")


@query("versioned_table", "SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY 1")
def _(spark, sf_dir):
    path = f"{shared_dir(spark)}/lodestone/versions-{uuid.uuid4().hex}"
    n = load(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"))
    sinks.replace(n.limit(1), path)
    sinks.replace(n, path, ["n_regionkey", "nations"])
    return sinks.read_version(spark, path)


@query("export_manifest", "SELECT c_mktsegment AS segment, count(*) AS rows FROM customer GROUP BY 1")
def _(spark, sf_dir):
    path = f"{shared_dir(spark)}/lodestone/export-{uuid.uuid4().hex}"
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    return sinks.export_by(c, path, "segment").select("segment", "rows")


@query(
    "minimised_reports",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m') AS event_month, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 3 AS VARCHAR) END AS hospitalized FROM orders""",
)
def _(spark, sf_dir):
    from lodestone.operators.minimise import minimise

    raw = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("date"),
        F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(F.concat((F.col("o_orderkey") % 3).cast("string"), F.lit(".0"))).alias("hospitalized"),
        F.lit("12 Oak Street").alias("address"),
    )
    out = minimise(raw, ["id", "status"], {"date": "event_month"}, ["hospitalized"])
    return out.select("id", "event_month", "status", F.col("hospitalized").cast("string").alias("hospitalized"))


def shout(text: str) -> str:
    """A stand-in for a model behind a network."""
    if "0" in text:
        raise ValueError("no zeros")
    return text.upper()


@query("model_calls", "SELECT c_custkey, CASE WHEN contains(CAST(c_custkey AS VARCHAR), '0') THEN NULL ELSE upper('n' || c_custkey) END AS result, CASE WHEN contains(CAST(c_custkey AS VARCHAR), '0') THEN 'ValueError: no zeros' END AS error FROM customer")
def _(spark, sf_dir):
    from lodestone.operators.models import call_model

    asked = load(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("n"), F.col("c_custkey").cast("string")).alias("request"))
    return call_model(asked, "request", shout).select("c_custkey", "response.result", F.col("response.errorMessage").alias("error"))
