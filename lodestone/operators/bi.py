"""Marts and checks behind dashboards."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import fahrenheit
from lodestone.operators.checks import join_one_to_one


def risk_band(remaining: Column, critical: float = 20, warning: float = 50) -> Column:
    return F.when(remaining <= critical, "critical").when(remaining <= warning, "warning").otherwise("healthy")


def fleet_status(predictions: DataFrame, last_cycles: DataFrame, keys: Sequence[str], cycle: str, last: str, predicted: str) -> DataFrame:
    """The prediction at each unit's last cycle with its risk band; a unit without one raises."""
    at_last = predictions.withColumnRenamed(cycle, last)
    out = join_one_to_one(last_cycles.select(*keys, last), at_last, [*keys, last], [predicted])
    return out.withColumn("risk_band", risk_band(F.col(predicted)))


def latest(df: DataFrame, stamp: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest snapshot (of each group). The newest stamps are aggregated first, so the scan is not windowed."""
    newest = df.groupBy(*by).agg(F.max(stamp).alias(stamp))
    return df.join(newest, [*by, stamp], "left_semi")


def risk_kpis(status: DataFrame, predicted: str) -> DataFrame:
    return status.agg(
        F.count(F.lit(1)).alias("units"),
        *(F.count_if(F.col("risk_band") == b).alias(b) for b in ("critical", "warning", "healthy")),
        F.avg(predicted).alias("mean_remaining"),
    )


def label_delayed(log: DataFrame, endpoints: DataFrame, keys: Sequence[str], cycle: str, end_cycle: str, end_value: str, name: str = "actual") -> DataFrame:
    """What turned out to be true for predictions up to a unit's endpoint: its final value plus the cycles to it."""
    joined = log.join(endpoints.select(*keys, end_cycle, end_value), list(keys))
    return joined.filter(F.col(cycle) <= F.col(end_cycle)).withColumn(name, F.col(end_value) + F.col(end_cycle) - F.col(cycle))


def price_holds(usage: str = "u", price: str = "p", keys: Sequence[str] = ("sku",)) -> Column:
    """Whether a price holds for the whole of a usage record: it starts no earlier than the price, and ends no later unless the price is open.

    A record that goes on over a change of prices has none.
    """
    u, p = (lambda side: lambda c: F.col(f"{side}.{c}"))(usage), (lambda side: lambda c: F.col(f"{side}.{c}"))(price)
    out = (u("started") >= p("valid_from")) & ((u("ended") <= p("valid_to")) | p("valid_to").isNull())
    for k in keys:
        out = (u(k) == p(k)) & out
    return out


def cost_review(usage: DataFrame, prices: DataFrame, by: Sequence[str], today: Column, days: int = 7, keys: Sequence[str] = ("sku",)) -> DataFrame:
    """Units and their cost at list prices, for each group of the last ``days`` days and today.

    usage: the keys, units, started, ended and usage_date; prices: the keys, price, valid_from and valid_to, which is null for the price that
    still holds. The window is asked before the join, so that old usage isn't read.
    """
    recent = usage.filter((F.col("usage_date") >= F.date_sub(today, days)) & (F.col("usage_date") <= today)).alias("u")
    priced = recent.join(prices.alias("p"), price_holds(keys=keys)).select("u.*", "p.price")
    return priced.groupBy(*by).agg(F.sum("units").alias("units"), F.sum(F.col("units") * F.col("price")).alias("cost"))


def monthly_mart(days: DataFrame, by: Sequence[str], date: str, means: dict[str, str], maxima: dict[str, str], thresholds: dict[str, tuple[str, float]]) -> DataFrame:
    """(by, month, days, complete, means, maxima, and for each threshold the days on which a series in °C reaches its °F).

    One row a place and month from one row a place and day; a month is complete if each of its days is there.
    """
    reaches = {name: F.count_if(fahrenheit(F.col(series)) >= limit).cast("int").alias(name) for name, (series, limit) in thresholds.items()}
    month = days.groupBy(*by, F.trunc(date, "MM").alias("month_start")).agg(
        F.count(F.lit(1)).cast("int").alias("days"),
        *(F.avg(series).alias(name) for name, series in means.items()),
        *(F.max(series).alias(name) for name, series in maxima.items()),
        *reaches.values(),
    )
    complete = (F.col("days") == F.dayofmonth(F.last_day("month_start"))).alias("complete")
    return month.select(*by, F.date_format("month_start", "yyyy-MM").alias("month"), "days", complete, *means, *maxima, *thresholds)


def ask(spark: SparkSession, sql: str, marts: dict[str, DataFrame], **values) -> DataFrame:
    """The answer to a question in SQL: marts stand in it as ``{name}``, values as ``:name``. What a user types is a value, never SQL text.

    A question that reads anything but the marts raises.
    """
    used = {name: df for name, df in marts.items() if f"{{{name}}}" in sql}
    foreign = set(tables_read(spark, sql.format(**{name: name for name in used}))) - set(used)
    if foreign:
        raise ValueError(f"reads {', '.join(sorted(foreign))}")
    return spark.sql(sql, args=values or None, **used)


def _nodes(tree) -> Iterator[dict]:
    """All nodes of a parsed plan, those of subqueries and of common table expressions included."""
    for part in tree.values() if isinstance(tree, dict) else tree:
        if isinstance(part, (dict, list)):
            yield from _nodes(part)
    if isinstance(tree, dict):
        yield tree


def _parsed(spark: SparkSession, sql: str) -> list[dict]:
    """The nodes of what Spark's own parser makes of the SQL; text that isn't SQL raises."""
    return list(_nodes(json.loads(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toJSON())))


def _names(node: dict, field: str) -> list[str]:
    return node[field].strip("[]").split(", ") if node.get(field) else []


def tables_read(spark: SparkSession, sql: str) -> set[str]:
    """Tables that the SQL reads, without its own common table expressions."""
    nodes = _parsed(spark, sql)
    own = {n["_1"].lower() for n in nodes if n.get("product-class") == "scala.Tuple3" and isinstance(n.get("_1"), str)}
    return {t for n in nodes if (t := ".".join(_names(n, "multipartIdentifier"))) and t.lower() not in own}


def columns_named(spark: SparkSession, sql: str) -> set[str]:
    """Columns that the SQL names, in lower case, without what qualifies them."""
    return {_names(n, "nameParts")[-1].lower() for n in _parsed(spark, sql) if n.get("class", "").endswith("UnresolvedAttribute")}


def lint(spark: SparkSession, sql: str, allowed: set[str], forbidden_columns: Sequence[str], widget_columns: Sequence[str], result_columns: Sequence[str]) -> list[str]:
    """What is wrong with a dashboard dataset: tables outside the list, columns it must not name, widgets without a column."""
    out = [f"reads {t}" for t in sorted(tables_read(spark, sql) - allowed)]
    named = columns_named(spark, sql)
    out += [f"names {c}" for c in forbidden_columns if c.lower() in named]
    return out + [f"lacks {c}" for c in sorted(set(widget_columns) - set(result_columns))]


def table_ddl(name: str, columns: Sequence[tuple[str, str, str]], comment: str, key: Sequence[str] = ()) -> str:
    """CREATE TABLE IF NOT EXISTS with comments; key columns are NOT NULL. Quotes are escaped."""
    quote = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    parts = [f"  `{c}` {t}{' NOT NULL' if c in key else ''} COMMENT {quote(d)}" for c, t, d in columns]
    return f"CREATE TABLE IF NOT EXISTS {name} (\n" + ",\n".join(parts) + f"\n) USING parquet COMMENT {quote(comment)}"


IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*){0,2}")


def identifier(name: str) -> str:
    """The name, if it can go into SQL text as it is."""
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"not an identifier: {name!r}")
    return name
