"""SimHash near-duplicates by multi-index hashing, and near copies by exact Jaccard of shingles."""

from __future__ import annotations

from base64 import b64encode
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm import bloom, set_join
from lodestone.llm.arrow import SLICE, map_batches, texts
from lodestone.llm.graph import components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Near copies share at least 4/5 of their five-word shingles (set_join's NUM/DEN).
NEAR_SHINGLE = 5
#: Shingles hashed at a time, so that long texts need no more memory.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The majority of each bit over the XXH64 hashes of the text's word shingles, repeats included.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer words is one shingle; without
    words the fingerprint is zero.
    """
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, shingle):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total, ones = total + len(hashes), ones + bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def shingle_hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """The XXH64 hashes of the text's word shingles in order, in blocks; a text without words has none."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    if len(words) <= shingle:
        yield np.array([xxh64_intdigest(joined, SEED)], "<u8")
        return
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    total = len(words) - shingle + 1
    for at in range(0, total, BLOCK):
        to = min(at + BLOCK, total)
        yield np.array([xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts[at:to], ends[at + shingle - 1 : to + shingle - 1])], "<u8")


def shingle_set(text: str, shingle: int = NEAR_SHINGLE) -> np.ndarray:
    """The hashes of the text's distinct shingles."""
    blocks = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, np.uint64)


def dealt(hashes: np.ndarray, classes: np.ndarray) -> Iterator[tuple]:
    """The parts of a set of hashes as :func:`lodestone.llm.set_join.dealt` makes them: (total, classes, n, parities, prefix, leads).

    The parities are one number, ``odd`` above and ``parity`` in the lower 64 bits. ``hashes`` are sorted, as :func:`shingle_set` has them.
    """
    low = hashes[: set_join.LEADING]
    leads = [_mixed(low[[i, j]]) for i in range(len(low)) for j in range(i + 1, len(low))] if len(low) == set_join.LEADING else [_mixed(low)]
    keys = (classes[(hashes >> np.uint64(48)).astype(np.int64)].astype(np.uint64) << np.uint64(set_join.CLASS_AT)) | (hashes & np.uint64((1 << set_join.CLASS_AT) - 1))
    keys = np.sort(keys)
    keys, num, den = keys.view(np.int64), set_join.NUM, set_join.DEN
    own = set_join.class_count(len(keys))
    for count in sorted({own, set_join.class_count(len(keys) * den // num)}):
        up = set_join.KEY_BITS - (count.bit_length() - 1)
        turned = np.sort(((keys & (count - 1)) << up) | (keys >> (count.bit_length() - 1))) if count > 1 else keys
        named = turned >> up if count > 1 else np.zeros(len(keys), np.int64)
        starts = np.flatnonzero(np.concatenate(([True], named[1:] != named[:-1]))) if len(keys) else np.zeros(0, np.int64)
        words = [np.bitwise_xor.reduceat(one << (turned & 63), starts).view(np.uint64).tolist() if len(starts) else [] for one in (np.int64(1), (turned >> 6) & 1)]
        for at, end, p, odd in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], *words):
            n = end - at
            yield len(keys), count, n, odd << 64 | p, turned[at : at + n - -(-n * num // den) + 1], leads if count == own and not at else []


def _mixed(hashes: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.array(xxh64_intdigest(hashes.astype("<u8").tobytes(), SEED), np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed 64-bit integer; null text is the empty text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in texts(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, fp long")


def table_keys(fp: np.ndarray) -> np.ndarray:
    """The table entries of each fingerprint, 65 a row.

    Two fingerprints of at most four differing bits differ in at most two bits of the upper half or at most one
    of the lower. The upper half enters with its ball of radius one (two such balls meet if the halves differ in
    at most two bits), the lower with each bit masked in turn (equal under a mask: at most one differs).
    """
    upper, lower = fp >> np.uint64(32), fp & np.uint64(0xFFFFFFFF)
    bit = np.uint64(1) << np.arange(32, dtype=np.uint64)
    tag = (np.uint64(1) << np.uint64(62)) | (np.arange(32, dtype=np.uint64) << np.uint64(32))
    return np.concatenate([upper[:, None], upper[:, None] ^ bit, (lower[:, None] & ~bit) | tag], axis=1)


def linked(members: np.ndarray, radius: int = RADIUS) -> list[tuple[int, np.ndarray]]:
    """Stars that span the components of these fingerprints under links of at most ``radius`` bits.

    Every link is verified on the whole fingerprint. Found members leave the rest, so groups of near copies
    cost one pass each and no list of pairs is made.
    """
    rest, stars = members, []
    while len(rest) > 1:
        root, frontier, rest = rest[0], [rest[0]], rest[1:]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= radius
            if near.any():
                hit, rest = rest[near], rest[~near]
                stars.append((int(root), hit))
                frontier.extend(hit)
    return stars


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) between different fingerprints whose components are those of all links.

    Entries are dealt by key and sorted, so a task streams over its keys and holds one key's fingerprints, eight
    bytes each. A fingerprint that many documents share comes in once.
    """

    def enter(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = table_keys(fp)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(fp, keys.shape[1]).view(np.int64))], names=["key", "fp"]
        )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def edges(stars):
            u = [np.full(len(m), root, np.uint64) for root, m in stars]
            if u:
                both = [np.concatenate(u).view(np.int64), np.concatenate([m for _, m in stars]).view(np.int64)]
                pairs = np.unique(np.stack(both, axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            bounds = np.concatenate(([0], cuts, [len(key)]))
            stars = []
            if held and key[0] != held_key:
                stars += linked(np.concatenate(held), radius)
                held = []
            first_end = bounds[1]
            if held:
                held.append(fp[:first_end])
                if len(bounds) > 2:
                    stars += linked(np.concatenate(held), radius)
                    held = []
                starts, ends = bounds[1:-1], bounds[2:]
            else:
                starts, ends = bounds[:-1], bounds[1:]
            if len(starts):
                many = ends[:-1] - starts[:-1] > 1
                for a, b in zip(starts[:-1][many], ends[:-1][many]):
                    stars += linked(fp[a:b], radius)
                held = [fp[starts[-1] :]]
            held_key = key[-1]
            yield from edges(stars)
        if held:
            yield from edges(linked(np.concatenate(held), radius))

    if radius != RADIUS:
        raise ValueError("the tables are made for four differing bits")
    entries = map_batches(fps.select("fp"), enter, "key long, fp long")
    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(match, "u long, v long").distinct()


def rooted(each: DataFrame) -> DataFrame:
    """(fp, first, root) for the rows (fp, first) of different fingerprints: root tells the groups apart."""
    each = stage(each, "distinct")
    roots = components(links(each)).select(F.col("u").alias("fp"), "root")
    return each.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most four bits are linked, equal fingerprints included; component_id
    is the smallest id that links reach. Fingerprints go into a narrow table, so each text is read once; links are
    sought among different fingerprints only, and group members join their group in a join that adaptive execution splits.

    Defined cases: texts without words (null, empty, blank) have fingerprint zero and are linked with each other;
    rows may repeat; null ids never name a group (a group without ids has a null component_id); an empty table gives
    no rows; further columns are ignored.
    """
    found = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    grouped = rooted(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    named = grouped.join(grouped.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    named = stage(named.select("fp", "component_id"), "named")
    return found.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _counts(source: DataFrame, shingle: int) -> DataFrame:
    """(counter, count) of the distinct shingles of each text (the column ``text``), summed over a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(set_join.COUNTERS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for t in texts(batch.column(0).slice(at, SLICE)):
                    np.add.at(total, (shingle_set(t, shingle) >> np.uint64(48)).astype(np.int64), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["counter", "count"])

    return source.select("text").mapInArrow(run, "counter int, count long")


PARTS = "array<struct<total int, classes int, n int, parity long, odd long, prefix array<bigint>, leads array<bigint>>>"


def _parts(read: list[str], classes: np.ndarray, shingle: int) -> pa.Array:
    """The parts of each text's shingle set, as a column of type PARTS."""
    made = [list(dealt(shingle_set(t, shingle), classes)) for t in read]
    flat = [part for parts in made for part in parts]
    total, count, n, parity, prefix, leads = zip(*flat) if flat else ((),) * 6
    ends = lambda lists: pa.array([0, *accumulate(map(len, lists))], pa.int32())
    lists = [
        pa.ListArray.from_arrays(ends(prefix), pa.array(np.concatenate(prefix) if flat else [], pa.int64())),
        pa.ListArray.from_arrays(ends(leads), pa.array([x for some in leads for x in some], pa.int64())),
    ]
    words = [pa.array(np.array([p >> shift & (1 << 64) - 1 for p in parity], np.uint64).view(np.int64)) for shift in (0, 64)]
    columns = [pa.array(total, pa.int32()), pa.array(count, pa.int32()), pa.array(n, pa.int32()), *words, *lists]
    return pa.ListArray.from_arrays(ends(made), pa.StructArray.from_arrays(columns, ["total", "classes", "n", "parity", "odd", "prefix", "leads"]))


def later_texts(rows: DataFrame, parts: DataFrame, source: DataFrame, shingle: int) -> DataFrame:
    """Ids of the rows (id, doc_id, k1, k2; one a text) whose text has 0.8 of its shingles in common with the text of an earlier row.

    ``parts`` is a staged table of the rows' parts, which is deleted here; ``source`` (k1, k2, text) has each text at least once.
    """
    places = rows.select("id", F.coalesce("doc_id", F.lit(set_join.LAST)).alias("doc"), F.lit(0).alias("line_no"), "k1", "k2")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = pa.array([shingle_set(t, shingle).view(np.int64) for t in texts(batch.column(2))], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], keys], names=["k1", "k2", "keys"])

    def verify(pairs: DataFrame) -> DataFrame:
        named, bits = set_join.named_filter(pairs)
        wanted = stage(bloom.test(places, "id", named, bits).filter("maybe").drop("maybe"), "wanted")
        bits = bloom.bits_for(wanted.count())
        some = bloom.test(source.select("k1", "k2", "text"), "k1", bloom.filter_of(wanted.select("k1"), "k1", bits), bits).filter("maybe")
        # One copy of a text is enough, and its set is made after that.
        some = some.select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
        keys = map_batches(some, sets, "k1 long, k2 long, keys array<bigint>", 64)
        some = stage(keys.join(wanted, ["k1", "k2"]).select("id", "doc", "line_no", "keys"), "named")
        found = set_join.similar_later(pairs, some)
        for t in (some, wanted, pairs):
            discard(t)
        return found

    return set_join.later_matches(parts, verify)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = NEAR_SHINGLE) -> DataFrame:
    """The documents, all columns as they are, without the near copies of earlier ones.

    A document goes if its fingerprint's group has an earlier one, or if the sets of its and an earlier document's
    shingles have a Jaccard of 0.8 or more. Earlier means a smaller id, and for rows of one id an earlier place; rows
    without id come last. Removed documents count, so the earliest of documents that any links join always stays.

    The second rule is exact but for hashes: the sets of different texts are joined by prefixes of their rarest shingles
    (set_join), and every pair is verified on the whole sets, which are made anew for the documents that pairs name.
    Rows are told apart by id and text.

    Defined cases: texts without words are copies of each other; of rows that repeat id and text one stays; an empty table gives no rows.
    """

    keyed = docs.select(F.xxhash64(text_col).alias("k1"), F.xxhash64(text_col, F.lit(1)).alias("k2"), F.col(text_col).cast("string").alias("text"))
    classes = np.array(set_join.frequency_classes(_counts(keyed, shingle)), np.uint8)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        read = texts(batch.column(4))
        fps = np.array([fingerprint(t) for t in read], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(fps), _parts(read, classes, shingle)], names=["id", "doc_id", "k1", "k2", "fp", "parts"])

    hashes = (F.xxhash64(text_col), F.xxhash64(text_col, F.lit(1)))
    source = docs.select(F.monotonically_increasing_id(), F.col(id_col).cast("long"), *hashes, F.col(text_col).cast("string"))
    wide = stage(map_batches(source, run, f"id long, doc_id long, k1 long, k2 long, fp long, parts {PARTS}", 64), "wide")
    rows = stage(wide.drop("parts"), "rows")
    order = F.struct(F.coalesce("doc_id", F.lit(set_join.LAST)), "id", "doc_id", "k1", "k2")
    firsts = stage(rows.groupBy("k1", "k2").agg(F.min(order).alias("first")).select("first.id"), "firsts")
    parts = wide.join(firsts, "id", "left_semi").select("id", F.coalesce("doc_id", F.lit(set_join.LAST)).alias("doc"), F.lit(0).alias("line_no"), F.explode("parts").alias("part"))
    parts = stage(parts.select("id", "doc", "line_no", "part.*"), "dealt")
    discard(wide)
    later = later_texts(rows.join(firsts, "id", "left_semi"), parts, keyed, shingle)
    grouped = rooted(rows.groupBy("fp").agg(F.min(order).alias("first")))
    first = grouped.groupBy("root").agg(F.min("first").alias("first")).select("first.*").join(later, "id", "left_anti")
    place = ["_lodestone_doc", "_lodestone_none", "_lodestone_k1", "_lodestone_k2"]
    placed = lambda df, c, k1, k2: df.withColumns(dict(zip(place, (F.coalesce(c, F.lit(0)), c.isNull(), k1, k2))))
    by_text = lambda df: placed(df, F.col("doc_id"), F.col("k1"), F.col("k2"))
    copies = by_text(rows.select("doc_id", "k1", "k2")).groupBy(*place).agg((F.count(F.lit(1)) > 1).alias("_lodestone_more"))
    kept = stage(by_text(first).select(*place).join(copies, place), "kept")
    discard(rows)
    discard(firsts)
    match = lambda which: placed(docs, F.col(id_col).cast("long"), *hashes).join(kept.filter(which).select(*place), place, "left_semi")
    return match("NOT _lodestone_more").unionByName(match("_lodestone_more").dropDuplicates(place)).select(docs.columns)

