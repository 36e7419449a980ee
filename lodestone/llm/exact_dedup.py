"""Exact de-duplication by two passes over a Bloom filter, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm import bloom

def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]{2,}|[\t-\r]", " ")


def repeated_bits(digests: DataFrame, bits: int) -> DataFrame:
    """The filter of bits that two or more rows set."""
    hits = digests.select(F.explode(F.array(*(bloom.bit(F.col("digest"), bits, k) for k in range(2)))).alias("bit"))
    return bloom.bitmaps(hits.groupBy("bit").count().filter("count > 1"))


def _tested(digests: DataFrame, max_bits: int) -> DataFrame:
    """The digests with ``maybe``: whether both bits of a digest were set more than once within its range."""
    rows = digests.count()
    ranges = -(-16 * rows // max_bits) if rows else 1
    if ranges <= 1:
        bits = min(max_bits, bloom.bits_for(rows))
        return bloom.test(digests, "digest", repeated_bits(digests, bits), bits)
    # Bits come from the digest's hash, so ranges are of another one.
    dealt = digests.withColumn("range", F.pmod(F.xxhash64("digest", F.lit(7)), F.lit(ranges)).cast("int"))
    dealt = stage(dealt, "digest-ranges", by="range")
    discard(digests)
    done = None
    for r in range(ranges):
        mine = dealt.filter(F.col("range") == r).drop("range")
        part = stage(bloom.test(mine, "digest", repeated_bits(mine, max_bits), max_bits), "tested")
        done = part if done is None else done.unionAll(part)
    discard(dealt)
    return done


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = bloom.MAX_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Pass 1 writes a narrow table of digests (text is read once) and builds the Bloom filter of bits
    that more than one row sets. Pass 2 tests every row: a row with a bit that nobody else sets is
    unique and passes straight through; only the rest shuffle, with 32-byte digests, to be grouped.
    The filter has 16 bits a row. Where that would be more than ``max_bits``, digests are written by ranges of their
    hash, and each range has a filter of its own, tested in a pass over that range only; so the filter
    that is broadcast never grows, and it lets no more rows through, whatever their number. A hot digest is
    counted map-side first, and its members join their group in a left join that adaptive execution splits.

    Defined cases: null text is the empty text; a null id sorts after all others, so it is kept only
    in a group without ids; of repeated rows with equal id and text exactly one has ``kept``; an
    empty table gives no rows; further columns are ignored.
    """
    sha = F.unhex(F.sha2(normalised(F.col(text_col)), 256))
    digests = stage(
        docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"), sha.alias("digest")),
        "digests",
    )
    tested = _tested(digests, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("rid"))).alias("first")
    # A table of its own, so that the join below deals both sides itself and a hot digest can be split.
    groups = stage(tested.filter("maybe").groupBy("digest").agg(first, F.count(F.lit(1)).alias("size")), "groups")
    members = tested.filter("maybe").join(groups, "digest", "left")
    out = [F.lower(F.hex("digest")).alias("text_sha256")]
    return members.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        *out,
    ).unionAll(
        tested.filter("not maybe").select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *out
        )
    )
