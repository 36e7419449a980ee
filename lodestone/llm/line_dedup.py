"""Line de-duplication by an exact set-similarity join, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm import bloom, set_join


def split_words(line: Column) -> Column:
    """The words of a line that has some, repeats included: runs without ASCII white space, lower-cased."""
    blanks = F.when(line.rlike(r"[\t-\r]"), F.translate(line, "\t\n\x0b\f\r", "     ")).otherwise(line)
    return F.array_remove(F.split(F.lower(blanks), " "), "")


def hashes(line: Column) -> Column:
    return F.transform(split_words(line), lambda w: F.xxhash64(w))


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, line_no, line) of each line that has a word; ``copy`` tells texts of one id apart."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("copy"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.filter(F.col("line").rlike(r"[^ \t-\r]"))


def counts(lines: DataFrame) -> DataFrame:
    """(counter, count) of the words of all lines, for the order of words by rarity."""
    return lines.select(F.explode(split_words(F.col("line"))).alias("w")).groupBy(set_join.counter(F.xxhash64("w")).alias("counter")).count()


def later_lines(lines: DataFrame) -> DataFrame:
    """Ids of the lines (id, doc, line_no, line) that have a similar line before them. Words are told apart by 64 bits of hash."""
    classes = set_join.frequency_classes(counts(lines))
    # Generators end a projection, so that hashes and keys are worked out once a line.
    hashed = lines.select("id", "doc", "line_no", F.explode(F.array(F.array_distinct(hashes(F.col("line"))))).alias("hashes"))
    sets = hashed.select("id", "doc", "line_no", set_join.lead_keys(F.col("hashes")).alias("leads"), F.explode(F.array(set_join.ordered_keys(F.col("hashes"), classes))).alias("keys"))

    def verify(pairs: DataFrame) -> DataFrame:
        named, bits = set_join.named_filter(pairs)
        some = bloom.test(lines.select("id", "doc", "line_no", "line"), "id", named, bits).filter("maybe")
        some = stage(some.select("id", "doc", "line_no", F.array_distinct(hashes(F.col("line"))).alias("keys")), "named")
        found = set_join.similar_later(pairs, some)
        discard(some)
        discard(pairs)
        return found

    return set_join.later_matches(stage(set_join.dealt(sets), "dealt"), verify)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, without the lines that have a similar line before them.

    A line's set is that of its lower-cased words; lines are similar at a Jaccard of 0.8 or more; before means an
    earlier line of the same document or any line of a document with a smaller id, removed lines included. Lines
    without words always stay. Lines are joined by line breaks as before.

    Equal lines become one by a map-side combined minimum; the similarity join works on different lines; then
    each line learns by its hash whether it stays, and a document's text moves once, to drop its lines.

    Defined cases: null and empty texts stay as they are; rows without id come last; rows that repeat id and text are
    one document to this operator and get equal results; a document may end up with an empty text; an empty table
    gives no rows; further columns stay.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    placed = split_lines(source).withColumn("doc", F.coalesce("doc_id", F.lit(set_join.LAST)))
    # One number orders a line's places within the aggregation, whose buffer then has a fixed width.
    place = F.col("doc").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("line_no").cast("decimal(10,0)")
    lines = placed.groupBy("line").agg(F.min(place.cast("decimal(32,0)")).alias("ord"))
    parts = ["(ord - pmod(ord, 4294967296BD)) div 4294967296BD AS doc", "cast(pmod(ord, 4294967296BD) AS int) AS line_no"]
    digest = (F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"))
    lines = lines.withColumns({"id": F.monotonically_increasing_id(), "k1": digest[0], "k2": digest[1]})
    lines = stage(lines.selectExpr("id", *parts, "k1", "k2", "line"), "lines")
    matched = later_lines(lines).withColumn("matched", F.lit(True))
    verdicts = lines.select("id", F.col("doc").alias("doc0"), F.col("line_no").alias("no0"), "k1", "k2").join(matched, "id", "left")
    verdicts = stage(verdicts.select("k1", "k2", "doc0", "no0", F.coalesce("matched", F.lit(False)).alias("matched")), "verdicts")
    discard(lines)
    dropped = placed.select("doc_id", "copy", "doc", "line_no", *digest).join(verdicts, ["k1", "k2"]).filter("matched OR doc > doc0 OR line_no > no0 AND doc = doc0")
    gone = dropped.groupBy("doc_id", "copy").agg(F.collect_set("line_no").alias("_lodestone_gone"))
    gone = gone.select(F.coalesce("doc_id", F.lit(0)).alias("_lodestone_doc"), F.col("doc_id").isNull().alias("_lodestone_none"), F.col("copy").alias("_lodestone_copy"), "_lodestone_gone")
    key = [
        F.coalesce(docs[id_col].cast("long"), F.lit(0)) == F.col("_lodestone_doc"),
        docs[id_col].isNull() == F.col("_lodestone_none"),
        F.xxhash64(docs[text_col]) == F.col("_lodestone_copy"),
    ]
    gone = stage(gone, "gone")
    left = docs.join(gone, key, "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("_lodestone_gone", i)), "\n")
    text = F.when(F.col("_lodestone_gone").isNull(), F.col(text_col)).otherwise(kept)
    return left.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))
