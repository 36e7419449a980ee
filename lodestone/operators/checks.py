"""Checks between tables and within sequences."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_mean(value: str) -> Column:
    """The mean of values to nine decimals, summed as such: the same bits in whatever order rows come, which a sum of doubles isn't.

    Groups with values that are not finite, or of 10^20 and more, have the mean of doubles.
    """
    v = F.col(value).cast("double")
    small = F.abs(v) < 1e20
    total = F.sum(F.when(small, v.cast("decimal(38,9)"))).cast("double")
    return F.when(F.count_if(~small) == 0, total / F.count(v)).otherwise(F.avg(v))


def recomputed(raw: DataFrame, refine: Callable[[DataFrame], DataFrame], silver: DataFrame, keys: Sequence[str], values: Sequence[str], summarise: Callable[[DataFrame], DataFrame], gold: DataFrame, by: Sequence[str], numbers: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """(layer, compared, mismatches): both stored layers against what the raw rows give when all is worked out again from them.

    The refined rows are compared bit by bit, with rows that only one side has; the summary's numbers, each a comparison, within the tolerance, which is for what
    rounding does and not for sums of doubles in another order (:func:`exact_mean`), and a summary row that one side lacks or a number that is null on one side counts as a mismatch for each number.
    """
    again = refine(raw)
    rows = parity(silver, again, keys, values).select(F.lit("silver").alias("layer"), F.col("keys").alias("compared"), (F.col("missing") + F.col("extra") + F.col("different")).alias("mismatches"))
    tall = lambda df, name: df.select(*by, F.explode(F.array(*(F.struct(F.lit(n).alias("number"), F.col(n).cast("double").alias(name)) for n in numbers))).alias("_n")).select(*by, "_n.*")
    both = tall(gold, "stored").withColumn("_here", F.lit(True)).join(tall(summarise(again), "made").withColumn("_there", F.lit(True)), [*by, "number"], "full_outer")
    near = F.col("_here") & F.col("_there") & (F.col("stored").eqNullSafe(F.col("made")) | (F.abs(F.col("stored") - F.col("made")) <= tolerance))
    return rows.unionAll(both.agg(F.lit("gold").alias("layer"), F.count(F.lit(1)).alias("compared"), F.count_if(~F.coalesce(near, F.lit(False))).alias("mismatches")))


def offset_contiguity(df: DataFrame, partition: str, offset: str) -> DataFrame:
    """Per partition: rows, first and last offset, and whether no offset is missing or double."""
    out = df.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"), F.min(offset).alias("first_offset"), F.max(offset).alias("last_offset"))
    return out.withColumn("contiguous", F.col("last_offset") - F.col("first_offset") + 1 == F.col("rows"))


def sequence_check(df: DataFrame, unit: str, partition: str, offset: str, cycle: str) -> DataFrame:
    """Per unit: cycles that do not increase in delivery order, and partitions it was delivered to."""
    w = Window.partitionBy(unit, partition).orderBy(offset)
    steps = df.select(unit, partition, (F.col(cycle) <= F.lag(cycle).over(w)).alias("back"))
    return steps.groupBy(unit).agg(F.count_if("back").alias("out_of_order"), F.count_distinct(partition).alias("partitions"))


def parity(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row: keys missing on the right, extra there, and keys of both whose values differ, nulls being equal."""
    a = left.select(*keys, F.struct(*values).alias("_a"))
    b = right.select(*keys, F.struct(*values).alias("_b"))
    both = a.join(b, list(keys), "full_outer")
    return both.agg(
        F.count_if(F.col("_b").isNull()).alias("missing"),
        F.count_if(F.col("_a").isNull()).alias("extra"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("different"),
        F.count(F.lit(1)).alias("keys"),
    )


def numeric_parity(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """One row: compared keys, largest absolute difference, and how many exceed the tolerance."""
    both = left.select(*keys, F.col(value).alias("_a")).join(right.select(*keys, F.col(value).alias("_b")), list(keys))
    gap = F.abs(F.col("_a") - F.col("_b"))
    return both.agg(F.count(F.lit(1)).alias("compared"), F.max(gap).alias("max_difference"), F.count_if(gap > tolerance).alias("mismatches"))


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of counts for a join that should pair every row: unmatched on either side and repeated keys."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_b"))
    return a.join(b, list(keys), "full_outer").agg(
        F.count_if(F.col("_b").isNull()).alias("left_only"),
        F.count_if(F.col("_a").isNull()).alias("right_only"),
        F.count_if((F.col("_a") > 1) | (F.col("_b") > 1)).alias("repeated"),
    )


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Left join that raises where a row has no match or a required column is null."""
    joined = left.join(right.withColumn("_matched", F.lit(True)), list(keys), "left")
    ok = F.col("_matched").isNotNull()
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return joined.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("a row has no match")).cast("boolean"))).drop("_matched")


def digest(df: DataFrame, name: str = "digest", kind: str = "xxhash64") -> DataFrame:
    """One row that identifies the table's content whatever its order: row count and the sum of row hashes.

    ``md5`` takes the first 60 bits of the digest of the columns' text with ``|`` between, null as nothing, which other engines can
    work out too; the other kind is faster and knows null from the empty text.
    """
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns))
    hashes = {"xxhash64": lambda: F.xxhash64(*df.columns), "md5": lambda: F.conv(F.substring(F.md5(text), 1, 15), 16, 10)}
    row = hashes[kind]().cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("string").alias(name))


def ledger(counts: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """One row per table: its rows, the expected number, and whether they agree."""
    out = None
    for name, df in counts.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(expected[name]).cast("long").alias("expected"))
        out = row if out is None else out.unionAll(row)
    return out.withColumn("agrees", F.col("rows") == F.col("expected"))
