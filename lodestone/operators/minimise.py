"""Reports without what identifies people: fewer columns, coarser dates, checked counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_of(text: Column, pattern: str = "M/d/yyyy") -> Column:
    """A date as its month; the day is gone."""
    return F.date_format(F.try_to_timestamp(text, F.lit(pattern)), "yyyy-MM")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def whole_count(text: Column) -> Column:
    """A count: blank is unknown and stays null; anything but a whole number of zero or more raises."""
    known = blank_to_null(text)
    number = known.try_cast("double")
    good = number.isNotNull() & (number >= 0) & (number == F.floor(number)) & (number <= 2147483647)
    bad = F.raise_error(F.concat(F.lit("not a whole count: "), known)).cast("int")
    return F.when(known.isNull(), F.lit(None).cast("int")).when(good, number.cast("int")).otherwise(bad)


def minimise(df: DataFrame, keep: Sequence[str], dates: dict[str, str] | None = None, counts: Sequence[str] = ()) -> DataFrame:
    """Only the columns of ``keep`` (blank text as null), months of the named dates, and checked counts."""
    kept = [blank_to_null(F.col(c)).alias(c) for c in keep]
    months = [month_of(F.col(c)).alias(name) for c, name in (dates or {}).items()]
    return df.select(*kept, *months, *(whole_count(F.col(c)).alias(c) for c in counts))
