"""Expectations: named row rules that split a table into valid rows and quarantine."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


@dataclass(frozen=True)
class Rules:
    """Named SQL predicates. A rule that is unknown for a row counts as failed, so valid and quarantined rows complement each other."""

    rules: dict[str, str]

    def passes(self, name: str) -> Column:
        return F.coalesce(F.expr(self.rules[name]), F.lit(False))

    def is_valid(self) -> Column:
        out = F.lit(True)
        for name in self.rules:
            out = out & self.passes(name)
        return out

    def failed(self) -> Column:
        """Names of the rules the row fails, in the rules' order."""
        return F.array_compact(F.array(*(F.when(~self.passes(n), F.lit(n)) for n in self.rules)))

    def check(self, df: DataFrame) -> DataFrame:
        """Add ``failed_rules``; both sides of the split can then be taken from one plan."""
        return df.withColumn("failed_rules", self.failed())

    def valid(self, df: DataFrame) -> DataFrame:
        """Expect or drop."""
        return df.filter(self.is_valid())

    def quarantine(self, df: DataFrame) -> DataFrame:
        """The exact complement of :meth:`valid`, with the rules that failed."""
        return self.check(df.filter(~self.is_valid()))

    def enforce(self, df: DataFrame) -> DataFrame:
        """Expect or fail: the query raises as soon as a row fails a rule."""
        message = F.concat(F.lit("expectation failed: "), F.array_join(self.failed(), ", "))
        return df.filter(F.when(self.is_valid(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))

    def metrics(self, df: DataFrame) -> DataFrame:
        """One row per rule, with passed and failed counts, in one pass over the rows."""
        counts = df.agg(*(F.count_if(self.passes(n)).alias(n) for n in self.rules), F.count(F.lit(1)).alias("_rows"))
        pairs = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("passed")) for n in self.rules))
        return counts.select("_rows", F.explode(pairs).alias("r")).select("r.rule", "r.passed", (F.col("_rows") - F.col("r.passed")).alias("failed"))

    def observed(self, df: DataFrame, observation: Observation | str) -> DataFrame:
        """The checked rows, whose rules are counted as they pass by; a stream takes the name under which its progress reports the counts."""
        counts = [F.count_if(self.passes(n)).alias(n) for n in self.rules]
        return self.check(df).observe(observation, *counts, F.count(F.lit(1)).alias("_rows"))

    def write_split(self, df: DataFrame, path: str, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame, DataFrame]:
        """(valid rows, quarantine with its failed rules, metrics as of :meth:`metrics`), from one write in one pass over the rows.

        Both sides go to one table, partitioned by whether a row is valid. The counts are those of this very write: nothing is read
        again for them, and they can't be of other rows than those written.
        """
        spark, seen = df.sparkSession, Observation()
        valid = (F.size("failed_rules") == 0).alias("valid")
        self.observed(df, seen).select("*", valid).write.partitionBy("valid").mode(mode).parquet(path)
        written = spark.read.schema(self.check(df).select("*", valid).schema).parquet(path)
        sides = [written.filter("valid").drop("valid", "failed_rules"), written.filter("NOT valid").drop("valid")]
        return *sides, rule_counts(spark, [seen.get])


class StreamCounts(StreamingQueryListener):
    """Adds up what :meth:`Rules.observed` counts under a name, over all batches of a session's streams while it listens."""

    def __init__(self, name: str):
        self.name, self.batches, self.ended = name, {}, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            # A batch that is tried again counts once.
            self.batches[str(event.progress.id), event.progress.batchId] = seen.asDict()

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def metrics(self, spark: SparkSession) -> DataFrame:
        """The counts as of :meth:`Rules.metrics`, once a query has ended: reports come after the rows."""
        self.ended.wait(60)
        return rule_counts(spark, list(self.batches.values()))


def rule_counts(spark: SparkSession, seen: list[dict]) -> DataFrame:
    """(rule, passed, failed), a row a rule, from observed counts."""
    names = [n for n in (seen[0] if seen else {}) if n != "_rows"]
    rows = sum(s["_rows"] for s in seen)
    passed = {n: sum(s[n] for s in seen) for n in names}
    return spark.createDataFrame([(n, p, rows - p) for n, p in passed.items()], "rule string, passed long, failed long")


def finite(column: str) -> str:
    """A predicate that is true for numbers that are neither null, NaN nor infinite."""
    return f"{column} IS NOT NULL AND NOT isnan({column}) AND abs({column}) < double('Infinity')"


def integral_key(column: str) -> str:
    """A predicate for whole numbers in the positive int range, asked before the value is narrowed."""
    return f"{column} = floor({column}) AND {column} BETWEEN 1 AND 2147483647"


def all_finite(array: str) -> str:
    """A predicate that is true if an array's numbers are all finite. One expression, however many numbers there are."""
    return f"forall({array}, x -> {finite('x')})"


def trajectory_rules(width: int = 26, keys: int = 2) -> Rules:
    """Rules for trajectory lines parsed into ``tokens``, ``numbers`` and the keys as doubles."""
    return Rules(
        {
            "width": f"size(tokens) = {width}",
            "subset": "subset <> ''",
            "split": "split IN ('train', 'test')",
            "keys": f"{integral_key('unit')} AND {integral_key('cycle')}",
            "finite": all_finite(f"slice(numbers, {keys + 1}, {width - keys})"),
        }
    )


# Months of this century, industry codes (blank, a code of two to six digits, or a range of two sectors).
MONTH = "^20[0-9]{2}-(0[1-9]|1[0-2])$"
INDUSTRY = "^([0-9]{2,6}|[0-9]{2}-[0-9]{2})?$"
# Fixed contract: the rules of minimised reports.
REPORT_RULES = Rules(
    {
        "positive_id": "report_id > 0",
        "schema_conforms": "rescued IS NULL",
        "month_format": f"event_month RLIKE '{MONTH}'",
        "state_present": "length(state) > 1",
        "naics_format": f"naics RLIKE '{INDUSTRY}'",
        "narrative_present": "length(trim(narrative)) >= 20",
        "event_coded": "event_code IS NOT NULL",
    }
)


def event_rules(payload: str, keys: list[str], values: list[str], event_id: str, domains: dict[str, str] | None = None) -> Rules:
    """Rules for JSON events: an object, exactly these keys, keys in their domain, the id that the keys give, finite values.

    ``domains`` has a pattern for each key that is text; the other keys count from 1.
    """
    domains = domains or {}
    inside = [f"event.{k} RLIKE '{domains[k]}'" if k in domains else f"event.{k} >= 1" for k in keys]
    expected = ", ".join(f"'{k}'" for k in sorted(["event_id", *keys, *values]))
    return Rules(
        {
            "is_json_object": f"json_object_keys({payload}) IS NOT NULL",
            "exact_keys": f"array_sort(json_object_keys({payload})) = array({expected})",
            "key_domain": " AND ".join(inside),
            "id_matches": f"event.event_id = {event_id}",
            "finite_values": " AND ".join(f"({finite('event.' + v)})" for v in values),
        }
    )


# Fixed contract: each daily series, its unit, and the least and largest value that is plausible.
WEATHER_SERIES = {
    "temperature_2m_max": ("°C", -60, 60),
    "temperature_2m_mean": ("°C", -60, 60),
    "apparent_temperature_max": ("°C", -80, 75),
}


def weather_rules(series: dict[str, tuple[str, float, float]] = WEATHER_SERIES, highest: str = "temperature_2m_max", mean: str = "temperature_2m_mean") -> Rules:
    """Rules for days exploded from one response with parallel daily arrays, each day with ``i``, its place in them."""
    every = " AND ".join
    days = "datediff(window_end, window_start) + 1"
    return Rules(
        {
            "schema_conforms": "rescued IS NULL",
            "known_file_name": "location_id IS NOT NULL",
            "celsius_units": every(f"daily_units.{s} = '{unit}'" for s, (unit, _, _) in series.items()),
            "complete_series": every(f"size(daily.{s}) = {days}" for s in ["time", *series]),
            "date_matches_position": "date = date_add(window_start, i)",
            "has_values": every(f"{s} IS NOT NULL" for s in series),
            "plausible_values": every(f"{s} BETWEEN {low} AND {high}" for s, (_, low, high) in series.items()),
            "mean_not_above_max": f"{mean} <= {highest}",
        }
    )
