"""Evaluation metrics as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import stage
from lodestone.operators.quantiles import exact_quantiles


def asymmetric_penalty(error: Column) -> Column:
    """Late predictions (positive error) cost more than early ones."""
    return F.when(error < 0, F.expm1(-error / 13)).otherwise(F.expm1(error / 10))


def regression_aggregates(predicted: str, actual: str) -> list[Column]:
    error = F.col(predicted) - F.col(actual)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error).alias("bias"),
        F.sum(asymmetric_penalty(error)).alias("score"),
    ]


def segment_names(actual: Column, endpoint: Column, cap: int, bounds: Sequence[int]) -> Column:
    """All segments a row belongs to: all, endpoint, up to the cap, and one of the disjoint buckets."""
    buckets, low = [], None
    for high in [*bounds, None]:
        name = f"bucket_{low if low is not None else 0}_{high if high is not None else 'up'}"
        inside = F.lit(True) if low is None else actual > low
        buckets.append(F.when(inside if high is None else inside & (actual <= high), F.lit(name)))
        low = high
    return F.array_compact(F.array(F.lit("all"), F.when(endpoint, F.lit("endpoint")), F.when(actual <= cap, F.lit(f"actual_le_{cap}")), *buckets))


def segment_performance(df: DataFrame, version: str, predicted: str, actual: str, endpoint: str, cap: int, bounds: Sequence[int]) -> DataFrame:
    """Metrics per version and overlapping segment; segments without rows are left out. One shuffle of partial sums."""
    names = segment_names(F.col(actual), F.col(endpoint), cap, bounds)
    return df.withColumn("segment", F.explode(names)).groupBy(version, "segment").agg(*regression_aggregates(predicted, actual))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """The most frequent value of each group, the smallest of equals."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col("_best.v").alias(name))


def confusion(df: DataFrame, truth: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """One row per true label, one count column per predicted label."""
    return df.groupBy(truth).pivot(predicted, list(labels)).count().na.fill(0)


def label_scores(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of each label that is true or predicted anywhere; an undefined share counts as 0."""
    hits = df.select(F.explode(F.array(F.struct(F.col(truth).alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p")), F.struct(F.col(predicted).alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p")))).alias("x"), (F.col(truth) == F.col(predicted)).alias("same"))
    per = hits.filter(F.col("x.label").isNotNull()).groupBy(F.col("x.label").alias("label")).agg(
        F.sum("x.t").alias("support"), F.sum("x.p").alias("predicted"), F.sum(F.when(F.col("same") & (F.col("x.t") == 1), 1).otherwise(0)).alias("correct")
    )
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return per.select(
        "label",
        "support",
        "predicted",
        "correct",
        share(F.col("correct"), F.col("predicted")).alias("precision"),
        share(F.col("correct"), F.col("support")).alias("recall"),
        share(2 * F.col("correct"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def accuracy(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.avg(F.coalesce(F.col(truth) == F.col(predicted), F.lit(False)).cast("int")).alias("accuracy"))


def percentiles(df: DataFrame, value: str, points: dict[str, float]) -> DataFrame:
    """Exact percentiles with linear interpolation, and the maximum, as one row; all null where there are no values."""
    found = exact_quantiles(df, value, list(points.values()))
    named = found.select(*(F.col("quantiles")[i].alias(n) for i, n in enumerate(points)))
    return df.agg(F.max(value).alias("max")).join(named, F.lit(True), "left").select(*points, "max")


def ranking_metrics(ranked: DataFrame, query: str, rank: str, hit: str, base_rate: str, relevant: str, k: int = 10) -> DataFrame:
    """Per query over its k best results: precision at 5 and 10, reciprocal rank, hit at 1, nDCG at 10 and lift.

    ``hit`` is 0 or 1; ``relevant`` is how many relevant documents the query has, found or not. Discounted gain is binary, against
    a list that begins with all relevant documents. A query with fewer than k results raises.
    """
    gain = F.col(hit) / F.log2(F.col(rank) + 1)
    per = ranked.filter(F.col(rank) <= k).groupBy(query).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col(rank) <= 5, F.col(hit)).otherwise(0)).alias("_h5"),
        F.sum(hit).alias("_h10"),
        F.min(F.when(F.col(hit) == 1, F.col(rank))).alias("_first"),
        F.max(F.when(F.col(rank) == 1, F.col(hit))).alias("hit_at_1"),
        F.sum(gain).alias("_dcg"),
        F.max(base_rate).alias("_base"),
        F.max(relevant).alias("_relevant"),
    )
    per = per.filter(F.when(F.col("_n") == k, F.lit(True)).otherwise(F.raise_error(F.lit("a query has too few results")).cast("boolean")))
    places = F.least(F.lit(k), F.col("_relevant")).cast("int")
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(places, F.lit(1))), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    return per.select(
        query,
        (F.col("_h5") / 5).alias("precision_at_5"),
        (F.col("_h10") / 10).alias("precision_at_10"),
        F.coalesce(1 / F.col("_first"), F.lit(0.0)).alias("reciprocal_rank"),
        "hit_at_1",
        F.when(places > 0, F.col("_dcg") / ideal).otherwise(0.0).alias("ndcg_at_10"),
        F.try_divide(F.col("_h10") / 10, F.col("_base")).alias("lift_at_10"),
    )


#: Values of a block of a bootstrap's table, blocks at most, and resamples that a task draws at a time.
BLOCK_VALUES, MOST_BLOCKS, DRAWN = 4096, 4096, 64


def paired_bootstrap(df: DataFrame, first: str, second: str, samples: int = 2000, seed: int = 0) -> DataFrame:
    """One row: the mean difference first - second, the 2.5 and 97.5 percentiles (low, high) of its mean over resamples, and their number.

    A resample is as many draws with replacement as there are rows. Which row is drawn doesn't matter, only its difference, so
    the rows become one for each difference, with their number, and a resample one multinomial draw over these: what it costs depends
    on the different values. They stand in blocks; for each resample the draws are first dealt to blocks, by their rows, and then
    within them. All tasks deal by the same seed, so that they agree without talking to each other.

    Rows in which a side is null or NaN don't count; without others difference, low and high are null and samples is 0.
    """
    d = (F.col(first).cast("double") - F.col(second).cast("double")).alias("value")
    counts = df.select(d).filter("value IS NOT NULL AND NOT isnan(value)").groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    counts = stage(counts, "differences")
    blocks = max(1, min(MOST_BLOCKS, -(-counts.count() // BLOCK_VALUES)))
    placed = counts.withColumn("block", F.pmod(F.xxhash64("value"), F.lit(blocks)).cast("int"))
    totals = {r["block"]: r["n"] for r in placed.groupBy("block").agg(F.sum("count").alias("n")).collect()}
    shares, rows = [totals.get(b, 0) for b in range(blocks)], sum(totals.values())

    def draw(table: pa.Table) -> pa.Table:
        order = np.argsort(table["value"].to_numpy())
        value, count = table["value"].to_numpy()[order], table["count"].to_numpy()[order]
        block = table["block"][0].as_py()
        deal, own, sums = np.random.default_rng([seed, 0]), np.random.default_rng([seed, 1, block]), []
        for at in range(0, samples, DRAWN):
            mine = deal.multinomial(rows, np.array(shares) / rows, size=min(DRAWN, samples - at))[:, block]
            sums.append(own.multinomial(mine, count / count.sum(), size=len(mine)) @ value)
        return pa.table({"resample": pa.array(np.arange(samples, dtype=np.int32)), "sum": np.concatenate(sums) / rows})

    means = placed.groupBy("block").applyInArrow(draw, "resample int, sum double").groupBy("resample").agg(F.sum("sum").alias("m"))
    interval = means.agg(F.expr("percentile(m, 0.025D)").alias("low"), F.expr("percentile(m, 0.975D)").alias("high"), F.count("m").alias("samples"))
    return counts.agg((F.sum(F.col("value") * F.col("count")) / F.sum("count")).alias("difference")).join(interval)
