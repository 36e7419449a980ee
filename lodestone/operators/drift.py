"""Population stability, with and without matching of ages, and alert checks over snapshots.

Everything stays distributed: bin edges are a short array per feature, and shares are grouped counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.catalog import stage
from lodestone.operators.quantiles import quantiles_of_counts

#: Shares below this are raised to it; shares are not scaled again afterwards.
SHARE_FLOOR = 1e-6


def unpivot(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, feature, value), one row per feature."""
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features))
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.feature", "_p.value")


def value_counts(reference: DataFrame, current: DataFrame, features: Sequence[str], also: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(feature, value, ``also``, r, c, w): how many rows of the reference and of the current side have a feature's value, and the
    reference's sum of weights; a written table. Each side is read once and combined map-side; all else is worked out from this."""
    own = lambda df, r, c, w: unpivot(df.withColumn("_w", w), features, [*also, "_w"]).select("feature", "value", *also, F.lit(r).alias("r"), F.lit(c).alias("c"), F.col("_w").alias("w"))
    both = own(reference, 1, 0, F.col(weight).cast("double") if weight else F.lit(1.0)).unionByName(own(current, 0, 1, F.lit(0.0)))
    return stage(both.groupBy("feature", "value", *also).agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.sum("w").alias("w")), "value-counts")


def quantile_edges(counts: DataFrame, value: str, count: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, edges): the distinct inner quantiles of values with counts, in order, a row for each group."""
    each = counts.groupBy(*by, value).agg(F.sum(count).alias(count))
    inner = quantiles_of_counts(each, value, count, [i / bins for i in range(1, bins)], by, "edges")
    return inner.select(*by, F.array_sort(F.array_distinct("edges")).alias("edges"))


def bin_of(edges: Column, value: Column) -> Column:
    """How many edges are at or below the value."""
    return F.size(F.filter(edges, lambda e: e <= value))


def in_bins(counts: DataFrame, bins: int, also: Sequence[str] = ()) -> DataFrame:
    """(feature, bin, ``also``, r, c, w and the sums rv, cv of both sides' values): the value counts by bins of the reference's quantiles,
    all bins of a feature, empty ones included. The edges have a row for each feature, so they are broadcast."""
    edges = F.broadcast(quantile_edges(counts, "value", "r", bins, ["feature"]))
    sums = [F.sum(x).alias(x) for x in ("r", "c", "w")] + [F.sum(F.col("value") * F.col(x)).alias(f"{x}v") for x in ("r", "c")]
    found = counts.join(edges, "feature").groupBy("feature", bin_of(F.col("edges"), F.col("value")).alias("bin"), *also).agg(*sums)
    places = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"))
    return places.join(found, ["feature", "bin"], "left").na.fill(0, ["r", "c", "w", "rv", "cv"])


def indices(binned: DataFrame, **expected: str) -> DataFrame:
    """(feature, an index for each name): sum of (actual - expected) * ln(actual / expected) over the bins (feature, bin, c, ...).

    Shares are each bin's part of the column's sum, raised to the floor; the expected ones are of the named columns.
    """
    own = Window.partitionBy("feature")
    share = lambda x: F.greatest(F.coalesce(F.try_divide(F.col(x), F.sum(x).over(own)), F.lit(0.0)), F.lit(SHARE_FLOOR))
    shares = binned.select("feature", share("c").alias("_a"), *(share(x).alias(name) for name, x in expected.items()))
    return shares.groupBy("feature").agg(*(F.sum((F.col("_a") - F.col(n)) * F.log(F.col("_a") / F.col(n))).alias(n) for n in expected))


def psi(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10, weight: str | None = None) -> DataFrame:
    """(feature, psi): the stability index over bins whose edges come from the reference, whose rows may have weights."""
    return indices(in_bins(value_counts(reference, current, features, weight=weight), bins), psi="w")


def age_ratios(ages: DataFrame, age: str, bins: int) -> DataFrame:
    """(age, ratio): the weight of reference rows of each age, from the ages' counts (age, r, c) of both sides.

    Edges come from current ages; ages outside the range of current ones have ratio 0; the others their bin's current share over
    its reference share among rows in range. A bin with current but no reference rows raises.
    """
    known = ages.select(F.col(age).alias("_age"), F.col(age).cast("double").alias("_value"), "r", "c")
    ends = known.agg(F.min(F.when(F.col("c") > 0, F.col("_value"))).alias("_low"), F.max(F.when(F.col("c") > 0, F.col("_value"))).alias("_high"))
    one = F.broadcast(ends.join(quantile_edges(known, "_value", "c", bins)))  # one row each
    inside = F.coalesce(F.col("_value").between(F.col("_low"), F.col("_high")), F.lit(False))
    placed = known.join(one).withColumn("_bin", F.when(inside, bin_of(F.col("edges"), F.col("_value"))))
    sums = placed.filter(F.col("_bin").isNotNull()).groupBy("_bin").agg(F.sum("r").alias("_r"), F.sum("c").alias("_c"))
    totals = sums.agg(F.sum("_r").alias("_rs"), F.sum("_c").alias("_cs"))
    missing = F.raise_error(F.lit("some current ages have no reference rows to be weighed")).cast("double")
    ratio = F.when((F.col("_c") > 0) & (F.col("_r") == 0), missing).when(F.col("_r") > 0, (F.col("_c") / F.col("_cs")) / (F.col("_r") / F.col("_rs"))).otherwise(0.0)
    table = sums.join(F.broadcast(totals)).select("_bin", ratio.alias("_ratio"))  # a row a bin
    return placed.join(F.broadcast(table), "_bin", "left").select(F.col("_age").alias(age), F.coalesce("_ratio", F.lit(0.0)).alias("ratio"))


def with_age_weights(reference: DataFrame, current: DataFrame, age: str, bins: int = 10, name: str = "age_weight") -> DataFrame:
    """The reference with weights that give it the current ages' mix, as :func:`age_ratios` has them."""
    sides = reference.select(age, F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(current.select(age, F.lit(0).alias("r"), F.lit(1).alias("c")))
    ages = stage(sides.groupBy(age).agg(F.sum("r").alias("r"), F.sum("c").alias("c")), "ages")
    ratios = age_ratios(ages, age, bins).select(F.col(age).alias("_age"), F.col("ratio").alias(name))
    return reference.join(ratios, F.col(age).eqNullSafe(F.col("_age")), "left").drop("_age")


def drift(reference: DataFrame, current: DataFrame, features: Sequence[str], age: str, bins: int = 10) -> DataFrame:
    """(feature, psi, psi_age_matched, means and rows of both sides).

    Each side is read once, for a table of how often each value of a feature occurs with each age. From that come the ages' counts
    and ratios, the bins' edges, and both indices: sums by bin and age first, whose ages then get their weights.
    """
    counts = value_counts(reference, current, features, [age])
    first = counts.filter(F.col("feature") == features[0]).groupBy(age).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    ratios = age_ratios(stage(first, "ages"), age, bins).select(F.col(age).alias("_age"), "ratio")
    binned = in_bins(counts, bins, [age]).join(ratios, F.col(age).eqNullSafe(F.col("_age")), "left")
    sums = [F.sum(x).alias(x) for x in ("r", "c", "rv", "cv")]
    table = stage(binned.groupBy("feature", "bin").agg(*sums, F.sum(F.col("w") * F.coalesce("ratio", F.lit(0.0))).alias("m")), "bins")
    mean = lambda side, x: [F.try_divide(F.sum(f"{x}v"), F.sum(x)).alias(f"{side}_mean"), F.sum(x).alias(f"{side}_rows")]
    about = table.groupBy("feature").agg(*mean("reference", "r"), *mean("current", "c"))
    return indices(table, psi="r", psi_age_matched="m").join(about, "feature")


def alert_checks(performance: DataFrame, drift_snapshots: DataFrame, now: Column, segments: Sequence[str], max_rmse_increase: float, max_psi: float, max_age_hours: float) -> DataFrame:
    """(check, subject, value, threshold, breached) of one model version's snapshots.

    performance: segment, rmse, computed_at; drift_snapshots: feature, psi_age_matched, computed_at. Ages and the RMSE
    rise of each segment are always reported: without snapshots the age is infinite and the rise NaN, and both breach.
    """
    hours = lambda c: F.coalesce((F.unix_micros(now) - F.unix_micros(c)) / 3.6e9, F.lit(float("inf")))
    check = lambda kind, subject, value, most: F.struct(F.lit(kind).alias("check"), subject.alias("subject"), value.cast("double").alias("value"), F.lit(float(most)).alias("threshold"))
    # Each table is read once and ends up as one row: as many numbers as there are segments asked for, or features.
    own = F.col("segment").isin(*segments)
    rises = performance.groupBy("segment").agg((F.max_by("rmse", "computed_at") / F.min_by("rmse", "computed_at") - 1).alias("rise"), F.max("computed_at").alias("newest"))
    seen = rises.agg(F.max("newest").alias("newest"), F.map_from_entries(F.collect_list(F.when(own, F.struct("segment", "rise")))).alias("rises"))
    rise = lambda s: F.coalesce(F.try_element_at("rises", F.lit(s)), F.lit(float("nan")))
    first = seen.select(F.explode(F.array(check("snapshot_age_hours", F.lit("performance"), hours(F.col("newest")), max_age_hours), *(check("rmse_increase", F.lit(s), rise(s), max_rmse_increase) for s in segments))).alias("c"))
    latest = drift_snapshots.groupBy("feature").agg(F.max(F.struct("computed_at", "psi_age_matched")).alias("l"))
    drifts = latest.agg(F.max("l.computed_at").alias("newest"), F.collect_list(F.struct("feature", "l")).alias("each"))
    current = F.filter("each", lambda e: e["l"]["computed_at"] == F.col("newest"))
    each = F.transform(current, lambda e: check("psi_age_matched", e["feature"], e["l"]["psi_age_matched"], max_psi))
    second = drifts.select(F.explode(F.concat(F.array(check("snapshot_age_hours", F.lit("drift"), hours(F.col("newest")), max_age_hours)), each)).alias("c"))
    out = first.unionAll(second).select("c.*")
    # NaN compares as greater than any number, so a missing history breaches.
    return out.withColumn("breached", F.col("value") > F.col("threshold"))


def raise_on_breach(checks: DataFrame) -> DataFrame:
    """The checks; evaluating them raises if one is breached."""
    message = F.concat(F.lit("alert: "), F.col("check"), F.lit(" "), F.col("subject"))
    return checks.filter(F.when(F.col("breached"), F.raise_error(message).cast("boolean")).otherwise(True))
