"""Bloom filters as small tables of bitmaps, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one row of a filter table, as the bitmap functions have them.
BUCKET_BITS = 32768
#: A broadcast filter never exceeds this many bits (16 MB), whatever the input's size.
MAX_BITS = 1 << 27


def bits_for(rows: int, per_row: int = 16, most: int = MAX_BITS) -> int:
    """A power of two of about ``per_row`` bits a row, within the bounds."""
    return min(most, max(BUCKET_BITS, 1 << (per_row * max(rows, 1) - 1).bit_length()))


def bit(key: Column, bits: int, k: int) -> Column:
    """The k-th of two places of a key's hash."""
    return F.shiftrightunsigned(F.xxhash64(key), 32 * k).bitwiseAND(F.lit(bits - 1))


def bitmaps(places: DataFrame) -> DataFrame:
    """The filter table (bucket, bitmap) of the places in column ``bit``: at most bits / 32768 rows of 4 KB."""
    return places.groupBy((F.col("bit") / BUCKET_BITS).cast("long").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(bit % {BUCKET_BITS})").alias("bitmap")
    )


def filter_of(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The filter of all values of ``key``."""
    return bitmaps(keys.select(F.explode(F.array(*(bit(F.col(key), bits, k) for k in range(2)))).alias("bit")))


def repeated(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The filter of first places that two or more rows have."""
    hits = keys.select(bit(F.col(key), bits, 0).alias("bit")).groupBy("bit").count()
    return bitmaps(hits.filter("count > 1"))


def test(df: DataFrame, key: str, table: DataFrame, bits: int, name: str = "maybe", keep: Sequence[str] | None = None, places: int = 2) -> DataFrame:
    """Add ``name``: whether the first ``places`` places of the row's key are in the filter. The table is bounded, so it is broadcast."""
    out = df
    for k in range(places):
        side = F.broadcast(table.select(F.col("bucket").alias(f"_bucket{k}"), F.col("bitmap").alias(f"_bitmap{k}")))
        out = out.withColumn(f"_bit{k}", bit(F.col(key), bits, k)).withColumn(f"_bucket{k}", (F.col(f"_bit{k}") / BUCKET_BITS).cast("long"))
        out = out.join(side, f"_bucket{k}", "left")
    found = [
        F.expr(
            f"coalesce(shiftright(cast(conv(hex(substring(_bitmap{k}, cast((_bit{k} % {BUCKET_BITS}) / 8 as int) + 1, 1)), 16, 10) as int),"
            f" cast(_bit{k} % 8 as int)) & 1, 0) = 1"
        )
        for k in range(places)
    ]
    all_found = found[0] & found[1] if places > 1 else found[0]
    return out.select(*(keep or df.columns), all_found.alias(name))
