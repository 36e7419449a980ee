"""How the sources of a language differ in their use of terms: a tournament of blocks of sources, and each source's own terms."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm.words import BLOCK, Splitter, batches_of, counted, slices

#: Fixed values of the contract: terms are runs of letters A-Z and of all characters beyond ASCII; shares are counted in 10^-9.
SPLITTER = Splitter(bytes(b for b in range(128) if not chr(b).isalpha()))
UNIT_STEPS, UNIT_STEP, ADDED = 3, 1000, 5
#: Sources of a language stand in blocks of at least so many, of which there are at most so many.
LEAST_IN_BLOCK, MOST_BLOCKS = 8, 16
#: Shares that a task holds of one block: its sources times the terms of a slice.
CELLS = 1 << 22


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / total), where total is the sum of all counts + 5: by long division, so that 64 bits are enough."""
    if total >= (1 << 63) // UNIT_STEP:
        raise OverflowError(f"{total} terms in one group")
    rest, out = counts.astype(np.int64) + ADDED, np.zeros(len(counts), np.int64)
    for _ in range(UNIT_STEPS if len(counts) else 0):
        digits, rest = np.divmod(rest * UNIT_STEP, total)
        out = out * UNIT_STEP + digits
    return out + 1


def _packs(columns: list[pa.Array]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(texts, rows) of some BLOCK bytes together; a longer text by itself."""
    raws = [x or b"" for x in columns[0].cast(pa.binary()).to_pylist()]
    size = np.array([len(r) + 1 for r in raws])
    for rows in np.split(np.arange(len(raws)), np.flatnonzero(np.diff(np.cumsum(size) // BLOCK)) + 1):
        long = [k for k in rows if size[k] > BLOCK]
        yield from (([raws[k]], np.array([k])) for k in long)
        rest = np.array([k for k in rows if size[k] <= BLOCK], np.int64)
        if len(rest):
            yield [raws[k] for k in rest], rest


def _terms(raws: list[bytes], group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, counts, documents, groups) of texts with their groups' numbers."""
    if len(raws) == 1:
        # One text, which may be long: its different terms are held, not its words.
        seen: Counter = Counter()
        for words in SPLITTER.blocks(raws[0]):
            terms, counts = counted(slices(words.data, words.starts, words.ends))
            seen.update(dict(zip(terms.to_pylist(), counts.tolist())))
        terms = pa.array(list(seen), pa.large_string())
        return terms, np.array(list(seen.values()), np.int64), np.ones(len(seen), np.int64), np.full(len(seen), group[0])
    words = SPLITTER.split(b"\n".join(raws))
    doc = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), words.first, side="right")
    coded = slices(words.data, words.starts, words.ends).dictionary_encode()
    many = max(1, len(coded.dictionary))
    code = coded.indices.to_numpy().astype(np.int64)
    # Of each document's different terms one by one, then of each group's.
    by_doc, counts = np.unique(doc * many + code, return_counts=True)
    keys, place = np.unique(group[by_doc // many] * many + by_doc % many, return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, place, counts)
    return coded.dictionary.take(pa.array(keys % many)), totals, np.bincount(place, minlength=len(keys)), keys // many


def term_rows(source: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of the texts (lang, source, text), summed over a few hundred texts; and each group as an empty term."""

    def run(batches):
        for batch in batches_of(batches):
            pairs = pa.StructArray.from_arrays(batch.columns[:2], ["lang", "source"])
            known: dict[tuple, int] = {}
            group = np.array([known.setdefault((p["lang"], p["source"]), len(known)) for p in pairs.to_pylist()], np.int64)
            langs, sources = (pa.array([k[i] for k in known], pa.string()) for i in range(2))
            zero = pa.array(np.zeros(len(known), np.int64))
            made = [pa.RecordBatch.from_arrays([langs, sources, pa.array([""] * len(known)), zero, zero], names=NAMES)] if known else []
            for raws, rows in _packs([batch.column(2)]) if known else ():
                terms, counts, docs, own = _terms(raws, group[rows])
                own = pa.array(own)
                made.append(pa.RecordBatch.from_arrays([langs.take(own), sources.take(own), terms.cast(pa.string()), pa.array(counts), pa.array(docs)], names=NAMES))
            yield from made

    return source.mapInArrow(run, "lang string, source string, term string, n long, docs long")


NAMES = ["lang", "source", "term", "n", "docs"]


def _pack(cells: list | None) -> bytes:
    """Places and counts, compressed: a count's place as the distance from the one before."""
    cells = sorted((c["at"], c["n"]) for c in cells or ())
    at, n = np.array([c[0] for c in cells], np.int32), np.array([c[1] for c in cells], np.int64)
    return zlib.compress(np.diff(at, prepend=np.int32(0)).astype(np.int32).tobytes() + n.tobytes(), 1)


def _unpack(packed: bytes, many: int) -> np.ndarray:
    """The counts at all places."""
    raw = zlib.decompress(packed)
    k = len(raw) // 12
    out = np.zeros(many, np.int64)
    out[np.cumsum(np.frombuffer(raw, np.int32, k))] = np.frombuffer(raw, np.int64, k, 4 * k)
    return out


def packed(cells: DataFrame) -> DataFrame:
    """The table with its column ``cells`` as bytes."""
    kept = [c for c in cells.columns if c != "cells"]

    def run(batches):
        for batch in batches_of(batches, 64):
            last = pa.array([_pack(c) for c in batch.column(len(kept)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], last], names=[*kept, "packed"])

    schema = ", ".join(f"`{c}` {t}" for c, t in cells.dtypes if c != "cells") + ", packed binary"
    return cells.select(*kept, "cells").mapInArrow(run, schema)


def rounds(blocks: int) -> list[dict[int, int]]:
    """The rounds of a tournament in which all blocks meet once: in each, who visits whom."""
    seats = list(range(blocks + blocks % 2))
    out = []
    for _ in range(len(seats) - 1 if blocks > 1 else 0):
        pairs = list(zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2 :])))
        out.append({max(p): min(p) for p in pairs if max(p) < blocks})
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


FOUND = "lang string, source string, part string, item string, value long"
SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _matrix(rows: dict) -> np.ndarray:
    """The shares of each group of a block, a row each."""
    return np.array([shares(_unpack(p, m), t) for p, m, t in zip(rows["packed"], rows["many"], rows["total"])], np.int64).reshape(len(rows["packed"]), -1)


def _found(lang: str, rows: list[tuple]) -> pa.Table:
    source, part, item, value = zip(*rows) if rows else ((),) * 4
    return pa.table([pa.array([lang] * len(rows), pa.string()), pa.array(source, pa.string()), pa.array(part, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())], schema=SCHEMA)


def _meet(key, residents: pa.Table, visitors: pa.Table) -> pa.Table:
    """A visit: both directions of each pair of a resident and a visitor, over one slice of the terms."""
    own, other = residents.to_pydict(), visitors.to_pydict()
    out = []
    if own["source"] and other["source"]:
        theirs = _matrix(other)
        for a, mine in zip(own["source"], _matrix(own)):
            for b, v in zip(other["source"], np.abs(theirs - mine).sum(axis=1).tolist()):
                out += [(a, "pair", b, v), (b, "pair", a, v)]
    return _found(key[0].as_py(), out)


def _at_home(top: int):
    def meet(key, residents: pa.Table, visitors: pa.Table) -> pa.Table:
        """The round before the first: pairs within the block, and a heap of each source's terms against the language's shares."""
        own, terms = residents.to_pydict(), visitors.to_pydict()
        out, mine = [], _matrix(own)
        for k, a in enumerate(own["source"]):
            for b, v in zip(own["source"][k + 1 :], np.abs(mine[k + 1 :] - mine[k]).sum(axis=1).tolist()):
                out += [(a, "pair", b, v), (b, "pair", a, v)]
        if terms["terms"] and own["source"]:
            listed = sorted(terms["terms"][0], key=lambda t: t["at"])
            whole = shares(np.array([t["n"] for t in listed], np.int64), terms["total"][0])
            for a, p, packed, many in zip(own["source"], mine, own["packed"], own["many"]):
                more = p - whole
                more[_unpack(packed, many) == 0] = 0
                if (more > 0).sum() > top:
                    more[more < np.partition(more, -top)[-top]] = 0
                heap = heapq.nsmallest(top, ((-int(more[i]), listed[i]["term"].encode("utf-8", "surrogatepass"), i) for i in np.flatnonzero(more > 0)))
                out += [(a, "term", listed[i]["term"], -v) for v, _, i in heap]
        return _found(key[0].as_py(), out)

    return meet


def _slices(terms: Column, groups: Column, blocks: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(terms * F.ceil(groups / blocks) / CELLS)).cast("int")


def audit_sources(
    docs: DataFrame, least_docs: int = 30, top: int = 50, lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """Each source against every other one of its language, and its terms against the language: lang, source, part, item, value, rank.

    Terms are runs of letters A-Z, lower-cased, and of characters beyond ASCII; a language keeps those in ``least_docs`` or more of its
    documents. A group (or a whole language) gives each kept term 1 + floor(10^9 * (count + 5) / (N + 5 * V)), with its N occurrences of the V
    kept terms. Part ``pair``: the sum of the differences to another source's shares, over all kept terms. Part ``term``: the ``top`` terms of
    the group's own that have a larger share than in the language, by the difference. Ranks go by value, then by the item's bytes.

    The terms of a language are dealt into slices and its sources into blocks, so that a task holds CELLS shares of a block
    whatever there is of either. Blocks stay in their partitions; in each round of a tournament every other one visits another, as
    compressed counts, and a visit gives both directions of all its pairs. Sums over slices and ranks are aggregations and windows.

    Defined cases: null text, language and source are empty ones; a group without kept terms takes part with equal shares, and where a
    language keeps none all values are 0; rows may repeat and count each; a term counts once a document however long the text;
    an empty table gives no rows; further columns are ignored. More than 9 * 10^15 terms in a group raise.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), F.col(text_col).cast("string").alias("text"))
    counts = stage(term_rows(source).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    whole = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = stage(whole.filter(F.col("docs") >= least_docs).select("lang", "term", "n"), "kept")
    groups = counts.filter("term = ''").select("lang", "source")
    per_lang = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups"))
    blocks = max(1, min(MOST_BLOCKS, -(-(per_lang.agg(F.max("groups")).first()[0] or 0) // LEAST_IN_BLOCK)))
    sizes = per_lang.join(whole.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")), "lang", "left").na.fill(0, ["v", "n"])
    sizes = stage(sizes.select("lang", "v", (F.col("n") + ADDED * F.col("v")).alias("total"), _slices(F.col("v"), F.col("groups"), F.lit(blocks)).alias("slices")), "sizes")
    # A term's place: its slice, and its number in that.
    in_slice = Window.partitionBy("lang", "slice").orderBy("term")
    kept = whole.join(sizes.select("lang", "slices"), "lang").withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    kept = stage(kept.select("lang", "slice", "term", "n", (F.row_number().over(in_slice) - 1).alias("at")), "places")
    cells = counts.filter("term <> ''").select("lang", "source", "term", "n").join(kept.select("lang", "term", "slice", "at"), ["lang", "term"])
    cells = cells.groupBy("lang", "source", "slice").agg(F.collect_list(F.struct("at", "n")).alias("cells"), F.sum("n").alias("own"))
    cells = stage(packed(cells), "cells")
    own = cells.groupBy("lang", "source").agg(F.sum("own").alias("own"))
    listed = kept.groupBy("lang", "slice").agg(F.collect_list(F.struct("at", "term", "n")).alias("terms"), F.count(F.lit(1)).cast("int").alias("many"))
    every = groups.join(sizes, "lang").join(own, ["lang", "source"], "left").withColumn("total", F.coalesce("own", F.lit(0)) + ADDED * F.col("v"))
    every = every.withColumn("block", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) % blocks)
    every = every.select("lang", "source", "block", "total", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    residents = every.join(listed.select("lang", "slice", "many"), ["lang", "slice"], "left").join(cells.drop("own"), ["lang", "source", "slice"], "left")
    nothing = F.lit(_pack([]))
    residents = residents.select("lang", "slice", "block", "source", "total", F.coalesce("many", F.lit(0)).alias("many"), F.coalesce("packed", nothing).alias("packed"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    residents = stage(residents, "residents").repartition(parts, "lang", "slice", "block").persist()
    at_home = residents.groupBy("lang", "slice", "block")
    home = listed.drop("many").join(sizes.select("lang", "total"), "lang").withColumn("host", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = [at_home.cogroup(home.groupBy("lang", "slice", "host")).applyInArrow(_at_home(top), FOUND)]
    for visits in rounds(blocks):
        host = F.create_map(*(F.lit(x) for pair in visits.items() for x in pair))[F.col("block")]
        visitors = residents.withColumn("host", host).filter("host IS NOT NULL")
        met.append(at_home.cogroup(visitors.groupBy("lang", "slice", "host")).applyInArrow(_meet, FOUND))
    found = stage(reduce(DataFrame.unionAll, met), "met")
    residents.unpersist()
    for t in (counts, whole, kept, cells):
        discard(t)
    found = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).unionAll(found.filter("part = 'term'"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order)).filter((F.col("rank") <= top) | (F.col("part") == "pair"))
