"""Removal of repeated byte strings by suffix sorting over a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm.arrow import map_batches, texts

#: Repeated strings of this many bytes are removed.
LENGTH = 200
#: Anchors are strings of this many bytes; each string of LENGTH bytes has exactly one.
ANCHOR = 48
#: Symbols sorted together; a group of contexts with one anchor is not cut.
BLOCK = 1 << 20
#: An anchor with more open contexts than this is not one task's work: its strings are dealt singly.
CROWD = 1 << 14
POSITION_BITS = 24


# ---- suffix sorting -------------------------------------------------------------------------------------------


def _packed(*columns: np.ndarray) -> np.ndarray:
    """One integer for each row of the columns, in their lexicographic order."""
    out = columns[0].astype(np.int64)
    for c in columns[1:]:
        width = int(c.max(initial=0)) + 1
        if int(out.max(initial=0)) >= (1 << 62) // width:
            out = np.unique(out, return_inverse=True)[1]
        out = out * width + c
    return out


def suffix_order(s: np.ndarray) -> np.ndarray:
    """All suffixes of ``s`` (positive integers) in order.

    Difference cover modulo 3: triples at places not divisible by 3 are sorted and named; if names repeat, the
    string of names is sorted in the same way; then the other suffixes follow from one symbol and the rank of the
    suffix after it, and the two orders are merged by binary search.
    """
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s, np.zeros(3, np.int64)])
    places = np.arange(n + (n % 3 == 1))
    ones, twos, zeros = places[places % 3 == 1], places[places % 3 == 2], np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    key = _packed(t[sample], t[sample + 1], t[sample + 2])
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(fresh)
    if not fresh.all():
        order = suffix_order(names)
        names[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    sorted_sample = sample[order]
    by_zero = zeros[np.argsort(_packed(t[zeros], rank[zeros + 1]), kind="stable")]
    one, two = sorted_sample[sorted_sample % 3 == 1], sorted_sample[sorted_sample % 3 == 2]
    first, m0 = _packed(*(np.concatenate(c) for c in ((t[one], t[by_zero]), (rank[one + 1], rank[by_zero + 1])))), len(by_zero)
    before = np.searchsorted(first[:-m0], first[-m0:])
    second = _packed(*(np.concatenate(c) for c in ((t[two], t[by_zero]), (t[two + 1], t[by_zero + 1]), (rank[two + 2], rank[by_zero + 2]))))
    before = before + np.searchsorted(second[:-m0], second[-m0:])
    out = np.empty(len(sample) + m0, np.int64)
    at_zero = before + np.arange(m0)
    rest = np.ones(len(out), bool)
    rest[at_zero] = False
    out[at_zero], out[rest] = by_zero, sorted_sample
    return out[out < n]


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Of the joined contexts' places, those whose next ``length`` bytes, all in one context, also start elsewhere.

    The contexts, each ended by a symbol of its own, are suffix-sorted, and neighbours in that order are compared
    on ``length`` bytes, eight at a time. Returns a mask over the joined contexts without end symbols.
    """
    sizes = np.array([len(c) for c in contexts])
    joined = np.frombuffer(b"".join(contexts), np.uint8)
    symbols = np.empty(len(joined) + len(sizes), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = joined.astype(np.int64) + 1
    symbols[ends] = 257 + np.arange(len(sizes))
    order = suffix_order(symbols)
    plain = np.cumsum(inside) - inside
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))
    order = plain[order[inside[order]]]
    order = order[room[order] >= length]
    words = np.zeros(len(joined) + 8, np.uint64)
    words[: len(joined)] = joined
    for step in (1, 2, 4):
        words[:-step] |= words[step:] << np.uint64(8 * step)
    a, b = order[:-1], order[1:]
    for off in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        same = words[a + off] == words[b + off]
        a, b = a[same], b[same]
    mask = np.zeros(len(joined), bool)
    mask[a] = mask[b] = True
    return mask


# ---- anchors --------------------------------------------------------------------------------------------------


def anchors(raw: bytes, length: int = LENGTH, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """The anchors of a text: (hash, place, first, last).

    Of the ``size``-byte strings inside a string of ``length`` bytes the one of the smallest hash is its anchor, the
    leftmost of equals. That depends on the string only, so equal strings have equal anchors in the same place.
    Each anchor stands for the starts first..last of the strings it is the anchor of.
    """
    n = len(raw)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    h = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    factor, span, whole = np.uint64(0x9E3779B97F4A7C15), 1, None
    done = 0
    while True:
        if size & span:
            whole = h.copy() if whole is None else (whole[: n - done - span + 1] * factor) ^ _mixed(h[done : n - span + 1])
            done += span
        if done == size:
            break
        h = (h[: len(h) - span] * factor) ^ _mixed(h[span:])
        span *= 2
    h = _mixed(whole[: n - size + 1])
    low = np.uint64((1 << POSITION_BITS) - 1)
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width, reach = length - size + 1, 1
    m = best
    while 2 * reach <= width:
        m = np.minimum(m[: len(m) - reach], m[reach:])
        reach *= 2
    if reach < width:
        m = np.minimum(m[: len(m) - (width - reach)], m[width - reach :])
    place = (m & low).astype(np.int64)
    cut = np.flatnonzero(place[1:] != place[:-1]) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(place)]]) - 1
    at = place[first]
    return h[at].view(np.int64), at, first, last


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def pieces(raw: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """The text in parts that overlap by ``length`` - 1 bytes, each short enough for an anchor's place."""
    most = 1 << (POSITION_BITS - 2)
    at = 0
    while True:
        yield at, raw[at : at + most + length - 1]
        at += most
        if at + length > len(raw):
            return


#: What is known of an anchor's row before it is dealt.
OPEN, SURE, STANDS_FOR = 0, 1, 2
ANCHORS = "anchor long, context long, key long, first long, last long, state long"


def find_anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per anchor of each text: its hash, its context's hash, and where it stands for strings to start.

    What a batch repeats is settled in the batch, as a map-side combine: rows of a context that it has twice are SURE,
    and the first of them also STANDS_FOR them where contexts of an anchor meet; other rows are OPEN.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        from xxhash import xxh3_64_intdigest

        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(5)]
        for key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            raw = text.encode("utf-8", "surrogatepass")
            for base, part in pieces(raw, length):
                h, at, first, last = anchors(part, length)
                if len(h):
                    around = [xxh3_64_intdigest(part[a : b + length], a - p & 0xFFFFFFFF) for a, b, p in zip(first.tolist(), last.tolist(), at.tolist())]
                    for column, x in zip(out, (h, np.array(around, np.uint64).view(np.int64), np.full(len(h), key), base + first, base + last)):
                        column.append(x)
        columns = [np.concatenate(c).astype(np.int64) for c in out]
        state = np.full(len(columns[0]), OPEN, np.int64)
        if len(state):
            order = np.lexsort((columns[1], columns[0]))
            a, c = columns[0][order], columns[1][order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])
            kind = np.cumsum(new) - 1
            again = np.bincount(kind)[kind] > 1
            state[order[again]] = SURE
            state[order[again & new]] = STANDS_FOR
        names = [c.split()[0] for c in ANCHORS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in [*columns, state]], names=names)

    # Whole batches, as what a batch repeats is combined.
    return map_batches(docs.select("key", "text"), run, ANCHORS, rows=1 << 20)


RESOLVED = "anchor long, key long, first long, last long, sure boolean"


def repeated_anchors(found: DataFrame) -> DataFrame:
    """Anchors that occur more than once, with what is known of them.

    Anchors are dealt by hash and sorted, and a task streams over them; rows that are sure already only pass, dealt
    evenly. An anchor seen once has no repeated string. Of those seen again, a context seen twice is repeated as a
    whole (sure); if all of an anchor's contexts are, that is all; else those seen once, and one of each other, go on
    to be compared (not sure). A task holds the rows of one anchor.
    """
    place = F.when(F.col("state") == SURE, F.xxhash64("key", "first")).otherwise(F.col("anchor"))
    dealt = found.withColumn("place", place).repartition("place").sortWithinPartitions("anchor", "context", "key", "first")
    names = [c.split()[0] for c in RESOLVED.split(", ")]

    def rows(x: np.ndarray, sure: bool) -> pa.RecordBatch:
        columns = [pa.array(x[i]) for i in (0, 2, 3, 4)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(x.shape[1], sure))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((6, 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            now = np.stack([batch.column(i).to_numpy() for i in range(6)])
            passing = now[5] == SURE
            yield rows(now[:, passing], True)
            now = np.concatenate([held, now[:, ~passing]], axis=1)
            cut = np.flatnonzero(now[0, 1:] != now[0, :-1])
            held = now[:, cut[-1] + 1 :] if len(cut) else now
            if len(cut):
                yield from decide(now[:, : cut[-1] + 1])
        if held.shape[1]:
            yield from decide(held)

    def decide(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        anchor, context = x[0], x[1]
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new_context = new_anchor | np.concatenate([[True], context[1:] != context[:-1]])
        group = np.cumsum(new_anchor) - 1
        kind = np.cumsum(new_context) - 1
        times = np.bincount(kind, 1.0 + (x[5] == STANDS_FOR))[kind]
        kinds = np.bincount(group[new_context], minlength=group[-1] + 1)[group]
        alone = np.bincount(group, weights=times == 1)[group] > 0
        yield rows(x[:, times > 1], True)
        yield rows(x[:, new_context & (kinds > 1) & alone], False)

    return dealt.select("anchor", "context", "key", "first", "last", "state").mapInArrow(run, RESOLVED)


def contexts(docs: DataFrame, asked: DataFrame, length: int = LENGTH) -> DataFrame:
    """The bytes of the asked contexts: (anchor, key, first, bytes). Texts that nothing is asked of drop out in the join."""
    per_text = asked.groupBy("key").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("asked"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key, text, wanted in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            rows += [(w["anchor"], key, w["first"], raw[w["first"] : w["last"] + length]) for w in wanted]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["anchor", "key", "first", "bytes"])

    return map_batches(docs.select("key", "text").join(per_text, "key").select("key", "text", "asked"), run, "anchor long, key long, first long, bytes binary")


def sorted_contexts(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs (key, start, end) of repeated strings in contexts that share an anchor, by sorting their suffixes.

    All contexts of an anchor lie in one partition, side by side; a task joins whole groups to blocks and sorts
    each block's suffixes.
    """
    dealt = found.repartition("anchor").sortWithinPartitions("anchor")

    def solve(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        mask = repeated_starts([r[2] for r in rows], length)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        base = np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])])
        starts, ends = edge[::2], edge[1::2]
        if len(starts):
            # A run of starts ends with its context at the latest, as the last bytes of one start nothing whole.
            at = np.searchsorted(base, starts, side="right") - 1
            keys, firsts = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
            begin = firsts[at] + starts - base[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at]), pa.array(begin), pa.array(begin + (ends - starts) - 1 + length)], names=["key", "start", "end"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for anchor, key, first, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if anchor != last and size >= BLOCK:
                    yield from solve(rows)
                    rows, size = [], 0
                rows.append((key, first, raw))
                size += len(raw) + 1
                last = anchor
        if rows:
            yield from solve(rows)

    return dealt.mapInArrow(run, "key long, start long, end long")


def dealt_strings(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs (key, start, end) like :func:`sorted_contexts`, for anchors with crowds of contexts.

    Strings of one anchor are too many for one order, so each string goes by 128 bits of its own hash, counted map-side, and
    those that occur again are found in a join that adaptive execution splits.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        from xxhash import xxh3_128_digest

        keys, starts, hashes = [], [], []
        for key, first, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            n = len(raw) - length + 1
            hashes.append(b"".join([xxh3_128_digest(raw[i : i + length]) for i in range(n)]))
            keys.append(np.full(n, key))
            starts.append(np.arange(first, first + n))
        both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        columns = [np.concatenate(keys), np.concatenate(starts), both[:, 0], both[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names=["key", "start", "h1", "h2"])

    strings = stage(map_batches(found, run, "key long, start long, h1 long, h2 long"), "strings")
    again = stage(strings.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"), "again")
    return strings.join(again, ["h1", "h2"]).select("key", "start", (F.col("start") + length).alias("end"))


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, start, end): runs of bytes covered by strings of ``length`` bytes that start anywhere else too.

    ``docs`` has a unique ``key`` and ``text``. Runs of a text may overlap; see :func:`remove_repeats`.
    """
    known = stage(repeated_anchors(find_anchors(docs, length)), "anchors")
    asked = known.filter("not sure").select("anchor", "key", "first", "last")
    crowds = stage(asked.groupBy("anchor").count().filter(F.col("count") > CROWD).select("anchor"), "crowds")
    compared = stage(sorted_contexts(contexts(docs, asked.join(crowds, "anchor", "left_anti"), length), length), "spans")
    if crowds.count():
        compared = compared.unionAll(dealt_strings(contexts(docs, asked.join(crowds, "anchor", "left_semi"), length), length))
    discard(crowds)
    sure = known.filter("sure").select("key", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    return sure.unionAll(compared)


def with_row_keys(docs: DataFrame, name: str = "row_key") -> DataFrame:
    """The rows of a table of files with a number that tells all of them apart and that every scan agrees on.

    A row's number is its file's, above 40 bits, and its place in the file. Files are numbered by their names, in a table with
    a row a file that is broadcast: the driver holds more than that for every file that it plans to read.
    """
    path = F.col("_metadata.file_path")
    names = sorted(r[0] for r in docs.select(path.alias("path")).distinct().collect())
    if len(names) >= 1 << 23:
        raise ValueError("too many files to number")
    files = docs.sparkSession.createDataFrame(list(enumerate(names)), "_file long, _path string")
    placed = docs.select("*", path.alias("_path"), F.col("_metadata.row_index").alias("_row")).join(F.broadcast(files), "_path")
    key = F.call_function("shiftleft", F.col("_file"), F.lit(40)).bitwiseOR(F.col("_row"))
    return placed.withColumn(name, key).drop("_path", "_file", "_row")


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on demand ``kept`` (bytes) and ``spans``.

    A byte goes if a ``length``-byte string that covers it also starts anywhere else in the table, the same document
    included; matches never cross documents, and all are judged on the input.

    The corpus is cut down to where repeats can be: equal strings have equal anchors, so strings whose anchor is
    unique are unique. Anchors with their contexts' hashes are dealt by hash; contexts repeated as a whole are decided
    at once, and those that agree in part only have their suffixes sorted over a difference cover, partition by
    partition, and neighbours in the order compared; strings of an anchor with a crowd of contexts are dealt one by one. A context is repeated as a whole if its anchor's 64-bit hash and its own,
    which is of another kind, are; bytes decide wherever contexts differ. Texts move twice: for the contexts and for the result.

    ``key`` is a column of 64-bit row keys that repeated scans agree on; without one, the texts are first written with
    keys to the shared folder. Defined cases: null text is the empty text; ids may be null or repeat; texts shorter than
    ``length`` stay; an empty table gives no rows; further columns are ignored.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), (F.monotonically_increasing_id() if key is None else key).alias("key"))
    source = stage(chosen, "texts") if key is None else chosen
    spans = repeated_spans(source, length)
    per_text = spans.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text, starts, ends in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            runs = merged(starts or [], ends or [])
            edges = [0, *(x for r in runs for x in r), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((doc_id, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, [{"start": a, "end": b} for a, b in runs]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            kinds += [pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            names += ["kept", "spans"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    joined = source.join(per_text, "key", "left").select("doc_id", "text", "starts", "ends")
    return map_batches(joined, run, REMOVED + (", kept binary, spans array<struct<start:long,end:long>>" if with_text else ""))
