"""Phrases whose words occur together more often than their parts let expect, by counts of all n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm import bloom
from lodestone.llm.words import Splitter, Words, batches_of, counted, groups, hashes, joined, mixed, seed, slices

#: Fixed values of the contract: what ends a piece, and what else stands between words.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
SPLITTER = Splitter(BREAKS + BLANKS, BREAKS)
#: Keys that are held until they are sorted and counted, and rows of an Arrow batch of them.
HELD, SENT = 1 << 23, 1 << 17
#: A key and a count in one number: the lower bits count.
COUNT_BITS = 16
MOST = (1 << COUNT_BITS) - 1
#: A key's bits from here on are its second place in the filter, its lowest ones the first.
SECOND = 21
#: A decimal of all digits there are, for products beyond 64 bits.
WIDE = "decimal(38,0)"


def _ngrams(words: Words, n: int) -> np.ndarray:
    """Where the n-grams start that lie in one piece and end in a new word."""
    last = len(words.starts) - n + 1
    if last <= 0:
        return np.zeros(0, np.int64)
    inside = words.piece[:last] == words.piece[n - 1 :]
    inside[: max(0, words.old - n + 1)] = False
    return np.flatnonzero(inside)


def _keys(hashed: np.ndarray, at: np.ndarray, n: int, lang: np.uint64) -> np.ndarray:
    """A 64-bit key of each n-gram that starts at ``at``; it tells lengths and languages apart too."""
    total = np.full(len(at), lang + np.uint64(n), np.uint64)
    for k in range(n):
        total = mixed(total) + hashed[at + k]
    return mixed(total)


def _blocks(batches, most: int) -> Iterator[tuple[str, np.uint64, Words]]:
    for batch in batches_of(batches):
        for (lang,), rows in groups([batch.column(0)]):
            for words in SPLITTER.blocks(joined(batch.column(1).take(rows)), most - 1):
                yield lang, seed(lang), words


def counted_keys(source: DataFrame, most: int) -> DataFrame:
    """Rows ``packed`` of a key's upper 48 bits and a count: one for each n-gram of up to ``most`` words, summed over some millions of a task."""

    def run(batches):
        held, size = np.empty(HELD, np.int64), 0

        def settle():
            keys = held[:size]
            keys.sort()
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if size else np.zeros(0, np.int64)
            for at in range(0, len(first), SENT):
                some = first[at : at + SENT + 1]
                counts = np.diff(some if len(some) > SENT else np.append(some, size))
                some = keys[some[: len(counts)]] << COUNT_BITS
                while len(counts):
                    yield pa.RecordBatch.from_arrays([pa.array(some | np.minimum(counts, MOST))], names=["packed"])
                    some, counts = some[counts > MOST], counts[counts > MOST] - MOST

        for _, lang, words in _blocks(batches, most):
            hashed = hashes(words)
            for n in range(1, most + 1):
                keys = (_keys(hashed, _ngrams(words, n), n, lang) >> np.uint64(COUNT_BITS)).view(np.int64)
                while len(keys):
                    some, keys = keys[: HELD - size], keys[HELD - size :]
                    held[size : size + len(some)] = some
                    size += len(some)
                    if size == HELD:
                        yield from settle()
                        size = 0
        yield from settle()

    return source.mapInArrow(run, "packed long")


def frequent_keys(rows: DataFrame, least: int) -> DataFrame:
    """The keys of :func:`counted_keys` whose counts sum up to ``least`` or more. Rows are dealt and sorted by Spark; a task holds one batch."""

    def run(batches):
        last, count = -1, 0
        for batch in batches:
            packed = batch.column(0).to_numpy()
            keys = packed >> COUNT_BITS
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
            if not len(first):
                continue
            sums, keys = np.add.reduceat(packed & MOST, first), keys[first]
            if keys[0] == last:
                sums[0] += count
            elif count >= least:
                yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64())], names=["key"])
            last, count = int(keys[-1]), int(sums[-1])
            yield pa.RecordBatch.from_arrays([pa.array(keys[:-1][sums[:-1] >= least])], names=["key"])
        if count >= least:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64())], names=["key"])

    return rows.repartition(F.shiftright("packed", COUNT_BITS)).sortWithinPartitions("packed").mapInArrow(run, "key long")


def counted_phrases(source: DataFrame, most: int, filter_bits, bits: int) -> DataFrame:
    """(lang, size, phrase, count) of the n-grams whose keys pass the filter, summed over a block; and each block's words as size 0."""

    def run(batches):
        table = np.frombuffer(filter_bits.value, np.uint8)

        def has(place):
            place = place & np.uint64(bits - 1)
            return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for lang, number, words in _blocks(batches, most):
            hashed = hashes(words)
            made = [(0, pa.array([""], pa.large_string()), np.array([len(words.starts) - words.old]))]
            for n in range(1, most + 1):
                at = _ngrams(words, n)
                keys = _keys(hashed, at, n, number) >> np.uint64(COUNT_BITS)
                at = at[has(keys) & has(keys >> np.uint64(SECOND))]
                made.append((n, *counted(slices(words.data, words.starts[at], words.ends[at + n - 1]))))
            for n, phrases, counts in made:
                if len(phrases):
                    columns = [pa.array([lang] * len(phrases)), pa.array(np.full(len(phrases), n, np.int32)), phrases.cast(pa.string()), pa.array(counts.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "count"])

    return source.mapInArrow(run, "lang string, size int, phrase string, count long")


def phrase_counts(docs: DataFrame, most: int = 3, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, size, phrase, count) of all phrases of 1 to ``most`` words that occur ``least`` times or more, and each language's words as size 0.

    All n-grams become rows twice. The first time they are 48-bit keys with counts, so what is shuffled has eight bytes for each different
    n-gram of a task. Keys with enough occurrences, by far the fewest, make a Bloom filter of at most 16 MB; the second time only the
    n-grams that pass it are rows, with their words, and are counted by these. Keys that collide or pass by chance cost rows only.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    keys = stage(frequent_keys(counted_keys(source, most), least), "frequent")
    bits = bloom.bits_for(keys.count())
    places = [F.shiftright("key", k).bitwiseAND(F.lit(bits - 1)) for k in (0, SECOND)]
    table = bytearray(bits // 8)
    for r in bloom.bitmaps(keys.select(F.explode(F.array(*places)).alias("bit"))).toLocalIterator():
        at = r.bucket * bloom.BUCKET_BITS // 8
        table[at : at + len(r.bitmap)] = r.bitmap
    sent = spark.sparkContext.broadcast(bytes(table))
    counts = counted_phrases(source, most, sent, bits).groupBy("lang", "size", "phrase").agg(F.sum("count").alias("count"))
    counts = stage(counts.filter((F.col("count") >= least) | (F.col("size") == 0)), "phrases")
    discard(keys)
    return counts


def collocations(
    docs: DataFrame, most: int = 3, least: int = 10, percent: int = 50, top: int = 2000, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``most`` words: lang, rank, phrase, a, l, r, n, score.

    A phrase of ``least`` or more occurrences a is cut after its first k words; l and r count both parts, and the cut of the lowest
    floor(1000000 * a * a / (l * r)) is its score, the smallest k among equal ones. A phrase goes if a longer one that has it inside
    occurs in ``percent`` of its places or more; one word longer is enough to look at, as still longer ones are rarer and lie in those.

    Words are runs without blanks and without what ends a piece (. , ; : ! ? and line breaks), A-Z lower-cased; phrases lie within
    pieces. Counts are exact, products are decimals of 38 digits: enough for 10^16 occurrences.

    Defined cases: a null language is ``und``, a null text has no words; rows may repeat and count each; ties in score and a are
    ranked by the phrase's bytes; a text without breaks is counted in blocks that overlap by ``most`` - 1 words; an empty table
    gives no rows; further columns are ignored.
    """
    counts = phrase_counts(docs, most, least, lang_col, text_col)
    known = counts.filter("size > 0").select("lang", "phrase", "count")
    whole = counts.filter("size > 1").select("lang", "size", "phrase", F.col("count").alias("a"))
    split = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).withColumn("words", F.split("phrase", " "))
    part = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    split = split.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        split = split.join(known.select("lang", F.col("phrase").alias(side), F.col("count").alias(name)), ["lang", side])
    score = F.expr(f"1000000 * cast(a AS {WIDE}) * cast(a AS {WIDE}) div (cast(l AS {WIDE}) * cast(r AS {WIDE}))")
    scored = split.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = whole.filter("size > 2").withColumn("words", F.split("phrase", " "))
    inner = F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))
    inside = longer.select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    gone = whole.join(inside, ["lang", "phrase"]).filter(100 * F.col("longer").cast(WIDE) >= percent * F.col("a").cast(WIDE))
    left = scored.join(gone.select("lang", "phrase"), ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    n = counts.filter("size = 0").select("lang", F.col("count").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
