"""Scalar expressions shared by pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token_double(tokens: Column, place: int) -> Column:
    """The token at a place (from 1) as a double; null if there is none or it is no number."""
    return F.try_element_at(tokens, F.lit(place)).try_cast("double")


def tokens(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def matched(text: Column, pattern: str, group: int) -> Column:
    """The group of the first match; null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def safe_date(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def display_name(slug: Column) -> Column:
    """A slug as words with capitals."""
    return F.initcap(F.regexp_replace(slug, "-", " "))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), r"[^a-z0-9]+", "-")


def fahrenheit(celsius: Column) -> Column:
    """In this order of operations, on which thresholds depend."""
    return celsius * 9 / 5 + 32


def document(header: list[Column], body: Column) -> Column:
    """Header fields that are known, one a line, an empty line, and the body; null without a body."""
    return F.concat(F.concat_ws("\n", *header), F.lit("\n\n"), body)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def event_key(*parts: tuple[str, Column]) -> Column:
    """Event id from format parts and columns, such as ("%s-", split), ("%03d", unit)."""
    return F.format_string("".join(f for f, _ in parts), *(c for _, c in parts))


def unit_partition(unit: Column, partitions: int) -> Column:
    """All events of a unit go to one partition, which keeps their order."""
    return F.pmod(unit - 1, F.lit(partitions))
