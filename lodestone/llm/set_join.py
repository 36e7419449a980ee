"""An exact set-similarity join by rare prefixes, in DataFrame functions only.

Sets are arrays of 64-bit keys in one global order, rare keys first. Two sets of sizes n, m with o common keys have a Jaccard
of NUM/DEN or more if o >= NUM*(n+m)/(NUM+DEN).

A large set is joined in parts: its keys are dealt by hash into so many classes that a class has less than PART keys on
average. If the whole sets are similar, so are the parts of at least one class, for otherwise all common keys would be too
few for all keys. So each filter works on small sets, where it tells strangers from near copies: 128 parities
say nothing about sets of many hundreds of keys, which differ in half of the parities by chance alone. Sets are cut no sooner than
that: one of four small parts is often similar where the whole sets aren't, so that most pairs of a large group of near copies would pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm import bloom

#: Similarity as a fraction: Jaccard of at least 4/5.
NUM, DEN = 4, 5
#: Sets of at least this many keys are dealt into 4, 16, 64, ... classes, so that parts have fewer keys on average.
PART, FAN_BITS, MOST_LEVELS = 160, 2, 12
#: Counters of the key-frequency sketch.
COUNTERS = 1 << 16
#: A key, of 63 bits: frequency class above, hash below. The hash's lowest bits choose the part, or else the parity.
KEY_BITS, CLASS_AT = 63, 56
#: Sets of rows without id come after all others.
LAST = (1 << 63) - 1
#: A set looks for a leader by pairs of so many of its keys, among sets that differ in size by less than this factor.
LEADING, BAND = 3, 1.15
#: The index is dealt and joined in turns, each with its tenths of the keys, so that no more of it is on disk at once. The first is
#: small: it settles what is left of large groups, whose members share many keys.
TENTHS, TURNS = 10, ((0, 1), (1, 4), (4, 7), (7, 10))
#: The ids that a turn has settled are broadcast up to so many (some 30 MB); more are joined as adaptive execution decides.
MOST_BROADCAST = 1 << 20

SIMILAR_SIZES = f"{DEN} * least(a.n, b.n) >= {NUM} * greatest(a.n, b.n)"
#: Keys in one set only show up in the parities' difference, each at most once.
#: ``odd`` has those of the keys whose hash has the next bit, ``parity`` those of all.
PARITIES = "(bit_count(a.odd ^ b.odd) + bit_count(a.parity ^ a.odd ^ b.parity ^ b.odd))"
SIMILAR_PARITY = f"{NUM + DEN} * {PARITIES} <= {DEN - NUM} * (a.n + b.n)"

_N, _AT, _ERA = "({0}.info & 65535)", "(shiftright({0}.info, 16) & 32767)", "shiftright({0}.info, 32)"
_SIDES = [(x.format("a"), x.format("b")) for x in (_N, _AT, _ERA)]
#: The filters on two entries of one key. What the key's places leave possible if it is the first common one comes after the sizes. Sets that
#: both enter by the next class count meet by their own.
CANDIDATE = (
    "{DEN} * least({0}, {1}) >= {NUM} * greatest({0}, {1}) AND {5} <= {4} AND {BOTH} * least({0} - {2}, {1} - {3}) >= {NUM} * ({0} + {1})"
    " AND {BOTH} * {PARITIES} <= {LOST} * ({0} + {1}) AND (a.info & b.info & 2147483648) = 0"
).format(*_SIDES[0], *_SIDES[1], *_SIDES[2], NUM=NUM, DEN=DEN, BOTH=NUM + DEN, LOST=DEN - NUM, PARITIES=PARITIES)


def counter(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - int(math.log2(COUNTERS))).cast("int")


def frequency_classes(counts: DataFrame) -> list[int]:
    """A class for each counter of the sketch (counter, count): four for each doubling, rare ones first.

    Counts cover all keys of all sets. What comes to the driver is a row a counter, of the fixed number there is.
    """
    classes = [0] * COUNTERS
    rows = counts.groupBy("counter").agg(F.sum("count").alias("count")).collect()
    middle = math.log2(max(1, sum(r["count"] for r in rows)) / COUNTERS)
    for r in rows:
        classes[r["counter"]] = min(127, max(0, round(64 + 4 * (math.log2(r["count"]) - middle))))
    return classes


def ordered_keys(hashes: Column, classes: list[int]) -> Column:
    """The hashes, distinct ones, as sorted keys: a global order, as a key depends on its hash only.

    Classes are small integers, which the JVM keeps once each, so that the table stays in cache.
    """
    table = F.from_json(F.lit("[" + ",".join(map(str, classes)) + "]"), "array<int>")

    def key(h: Column) -> Column:
        level = F.call_function("shiftleft", F.get(table, counter(h)).cast("long"), F.lit(CLASS_AT))
        return level.bitwiseOR(h.bitwiseAND(F.lit((1 << CLASS_AT) - 1)))

    return F.sort_array(F.transform(hashes, key))


def lead_keys(hashes: Column) -> Column:
    """What a set finds a leader by: hashes of pairs of its least hashes. Those are any of its keys, common ones mostly in near copies."""
    low = F.slice(F.sort_array(hashes), 1, LEADING)
    pairs = [F.xxhash64(low[i], low[j]) for i in range(LEADING) for j in range(i + 1, LEADING)]
    return F.when(F.size(hashes) >= LEADING, F.array(*pairs)).otherwise(F.array(F.xxhash64(low)))


def class_count(n: int) -> int:
    """How many classes a set of ``n`` keys is dealt into."""
    c = 1
    while n >= PART * c:
        c <<= FAN_BITS
    return c


def _class_bits(n: Column) -> Column:
    steps = F.when(n < PART, F.lit(0))
    for level in range(1, MOST_LEVELS):
        steps = steps.when(n < PART << (FAN_BITS * level), F.lit(FAN_BITS * level))
    return steps.otherwise(F.lit(FAN_BITS * MOST_LEVELS))


def _shiftleft(x: Column, n: Column) -> Column:
    return F.call_function("shiftleft", x, n)


def _by_class(keys: Column, bits: Column) -> Column:
    """The keys rotated so that their class leads, sorted, with a mark before each class: one pass and a sort of numbers."""
    top = F.lit(KEY_BITS) - bits
    turned = lambda k: _shiftleft(k.bitwiseAND(_shiftleft(F.lit(1).cast("long"), bits) - 1), top).bitwiseOR(F.call_function("shiftright", k, bits))
    return F.sort_array(F.concat(F.transform(keys, turned), F.transform(_classes(bits), lambda j: _mark(j, bits))))


def _classes(bits: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), _shiftleft(F.lit(1).cast("long"), bits) - 1)


def _mark(j: Column, bits: Column) -> Column:
    return _shiftleft(j, F.lit(KEY_BITS) - bits)


def _cut(marked: Column, bits: Column) -> Column:
    """The classes of what :func:`_by_class` made, as arrays without the marks."""
    last = _shiftleft(F.lit(1).cast("long"), bits) - 1
    start = lambda j: F.call_function("array_position", marked, _mark(j, bits)).cast("int")
    end = lambda j: F.when(j == last, F.size(marked) + 1).otherwise(start(j + 1))
    return F.transform(_classes(bits), lambda j: F.slice(marked, start(j) + 1, end(j) - start(j) - 1))


def dealt(sets: DataFrame) -> DataFrame:
    """The parts of the sets (id, doc, line_no, keys, leads): for each the set's size ``total``, its own size, parities and prefix, and with
    a set's first part its ``leads``.

    A set that is little smaller than the next class count begins at enters by that count too, to meet larger sets.

    Every part enters with its ``n - ceil(NUM * n / DEN) + 1`` first keys, by either count. That is enough class by class: similar parts
    of n and m keys have at least NUM * (n + m) / (NUM + DEN) in common; as that is at most m, m is NUM * n / DEN at least, and so is what
    they have in common, while fewer keys than that stand behind the prefix. A smaller set's part may be larger than the other's in the
    very class that is similar, so nothing shorter will do before the sizes of both parts are known.
    """
    n = F.size("keys")
    own, next_up = _class_bits(n), _class_bits(F.floor(n * DEN / NUM))
    levels = F.array(F.struct(own.alias("bits"), F.lit(True).alias("own")), F.when(next_up > own, F.struct(next_up.alias("bits"), F.lit(False).alias("own"))))
    level = sets.select("*", F.explode(F.array_compact(levels)).alias("l")).select("id", "doc", "line_no", "leads", "keys", n.alias("total"), "l.bits", "l.own")
    # Generators end a projection, so that what they make is made once a row.
    marked = level.select("id", "doc", "line_no", "leads", "total", "bits", "own", F.explode(F.array(F.when(F.col("bits") == 0, F.col("keys")).otherwise(_by_class(F.col("keys"), F.col("bits"))))).alias("marked"))
    cut = F.when(F.col("bits") == 0, F.array("marked")).otherwise(_cut(F.col("marked"), F.col("bits")))
    part = marked.select("id", "doc", "line_no", "leads", "total", "bits", "own", F.posexplode(cut).alias("part", "keys")).filter("size(keys) > 0")
    bit = lambda k: _shiftleft(F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    parity = F.aggregate("keys", F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(bit(k)))
    next_bit = lambda k: F.call_function("shiftright", k, F.lit(6)).bitwiseAND(F.lit(1))
    odd = F.aggregate("keys", F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(_shiftleft(next_bit(k), k.bitwiseAND(F.lit(63)).cast("int"))))
    leads = F.when(F.col("own") & (F.col("part") == 0), F.col("leads")).otherwise(F.array().cast("array<bigint>"))
    length = n - F.ceil(n * NUM / DEN).cast("int") + 1
    classes = _shiftleft(F.lit(1), F.col("bits")).alias("classes")
    words = parity.alias("parity"), odd.alias("odd")
    return part.select("id", "doc", "line_no", "total", classes, n.alias("n"), *words, F.slice("keys", F.lit(1), length).alias("prefix"), leads.alias("leads"))


def _index_length(n: Column) -> Column:
    """How many keys a part needs to enter with if the other part isn't smaller."""
    return n - F.ceil(n * (2 * NUM) / (NUM + DEN)).cast("int") + 1


def _entries(parts: DataFrame, index: bool = False) -> DataFrame:
    """The prefix entries (token, id, info, parity, odd); tokens are cut to 32 bits, which can only add candidates.

    ``info`` is the part's size, the key's place from 0, whether the set enters by the next class count, and its era in 16, 15, 1 and
    31 bits. With ``index``, only entries that meet sets which aren't smaller, in era 0.
    """
    short = F.slice("prefix", F.lit(1), _index_length(F.col("n")))
    own = (F.col("classes") == 1) | (F.col("total") >= PART * F.shiftright("classes", FAN_BITS))
    sizes = F.col("n").cast("long").bitwiseOR(F.when(own, F.lit(0)).otherwise(F.lit(1 << 31)).cast("long")).alias("sizes")
    each = parts.select("id", sizes, "classes", "era", "parity", "odd", F.posexplode(short if index else F.col("prefix")).alias("at", "key"))
    sizes = _shiftleft(F.col("at").cast("long"), F.lit(16)).bitwiseOR(F.col("sizes"))
    info = sizes if index else _shiftleft(F.col("era"), F.lit(32)).bitwiseOR(sizes)
    return each.select(F.hash("key", "classes").alias("token"), "id", info.alias("info"), "parity", "odd")


def _eras(parts: DataFrame) -> Column:
    """A number of 31 bits for each set, in the order of ``doc`` as far as that many bits can tell."""
    low, high = parts.agg(F.min("doc"), F.max(F.when(F.col("doc") < LAST, F.col("doc")))).first()
    low, high = (low or 0) >> 2, (high if high is not None else low or 0) >> 2  # so that differences fit 63 bits
    spare = max(0, (high - low + 1).bit_length() - 31)
    place = F.least(F.call_function("shiftright", F.col("doc"), F.lit(2)), F.lit(high + 1)) - F.lit(low)
    return F.call_function("shiftright", place, F.lit(spare))


def _led(parts: DataFrame) -> DataFrame:
    """Pairs (id, other) of each set and an early one of about its size that it shares a leading key with, where parities let them be similar.

    Most leading keys are one set's own. A filter of the keys that come again leaves those out before anything is dealt by
    key; where it is full, more rows are dealt and the pairs are the same.
    """
    # Two rows of bands, the borders of one within those of the other, so that a group of one size is whole in either.
    size = F.log("total") / math.log(BAND)
    bands = F.explode(F.array(2 * F.floor(size), 2 * F.floor(size + 0.5) + 1)).alias("band")
    # Sets of one era are in any order, as long as it is one.
    order = _shiftleft(_eras(parts), F.lit(32)).bitwiseOR(F.xxhash64("id").bitwiseAND(F.lit((1 << 32) - 1)))
    heads = parts.filter(F.size("leads") > 0).withColumn("ord", order)
    # A set's first part stands for it here: near copies are mostly near in each part.
    banded = heads.select("leads", bands, "classes", "id", "ord", "n", "parity", "odd")
    each = banded.select(F.explode("leads").alias("key"), "band", "classes", "id", "ord", "n", "parity", "odd")
    each = each.select(F.xxhash64("key", "band", "classes").alias("lead"), "id", "ord", "n", "parity", "odd")
    bits = bloom.bits_for(2 * LEADING * parts.count())
    again = bloom.test(each, "lead", bloom.repeated(each, "lead", bits), bits, places=1).filter("maybe").drop("maybe")
    first = again.groupBy("lead").agg(*(F.min_by(c, "ord").alias(c) for c in ("id", "n", "parity", "odd")), F.count(F.lit(1)).alias("members"))
    met = again.alias("a").join(first.filter("members > 1").alias("b"), "lead")
    return met.filter(f"a.id <> b.id AND {SIMILAR_SIZES} AND {SIMILAR_PARITY}").select("a.id", F.col("b.id").alias("other")).distinct()


def _met(marked: DataFrame, turn: tuple[int, int]) -> DataFrame:
    """Pairs of different sets, one of them open, with a common prefix key whose turn it is, that pass the length, position and
    parity filters; smaller id first. A settled set is of use only to sets after it, so it meets none of earlier eras."""
    open_parts = marked.filter("NOT settled")
    a, b = _entries(open_parts), _entries(open_parts, index=True).unionAll(_entries(marked.filter("settled")))
    tenth = F.pmod("token", F.lit(TENTHS))
    mine = (tenth >= turn[0]) & (tenth < turn[1])
    met = a.filter(mine).alias("a").join(b.filter(mine).alias("b"), F.col("a.token") == F.col("b.token"))
    met = met.filter(f"a.id <> b.id AND {CANDIDATE}")
    return met.select(F.least("a.id", "b.id").alias("id"), F.greatest("a.id", "b.id").alias("other"))


def later_matches(parts: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Ids of the sets, dealt into ``parts`` (a staged table that is deleted here), that have a similar set before them.

    Before is by (doc, line_no, id), matched sets included. ``verify`` takes candidate pairs (id, other) and returns the ids of the later ones
    of those that are similar, with their whole keys compared.

    Each set first meets the earliest sets that two of its keys lead to, which settles groups of near copies in a few comparisons
    a set. Sets that are open then meet all sets with a common prefix key; of two open ones the smaller part needs a
    shorter prefix, so only that is indexed. No pair of two settled sets is ever made.
    """
    settled = verify(stage(_led(parts), "led"))
    marked = stage(_marked(parts, settled), "parts")
    discard(parts)
    found = settled
    for turn in TURNS:
        if turn != TURNS[0]:
            # What the last turn has settled is open no more.
            marked, before = stage(_marked(marked, settled), "parts"), marked
            discard(before)
        settled = verify(stage(_met(marked, turn).distinct(), "pairs"))
        found = found.unionAll(settled)
    discard(marked)
    return found.distinct()


def _marked(parts: DataFrame, settled: DataFrame) -> DataFrame:
    """The parts with an era, and whether their sets are settled, now or before."""
    era = F.col("era") if "era" in parts.columns else _eras(parts)
    known = F.col("_before") if "settled" in parts.columns else F.lit(False)
    now = settled.select("id", F.lit(True).alias("settled"))
    now = F.broadcast(now) if settled.count() <= MOST_BROADCAST else now
    both = parts.withColumnsRenamed({"settled": "_before"}).withColumn("era", era).join(now, "id", "left")
    return both.select("id", "era", "total", "classes", "n", "parity", "odd", "prefix", F.coalesce("settled", known).alias("settled"))


def named_filter(pairs: DataFrame) -> tuple[DataFrame, int]:
    """A Bloom filter of bounded size of the ids that the pairs name, and its bits."""
    named = pairs.select("id").unionAll(pairs.select(F.col("other").alias("id"))).distinct()
    bits = bloom.bits_for(2 * pairs.count())
    return bloom.filter_of(named, "id", bits), bits


def similar_later(pairs: DataFrame, some: DataFrame) -> DataFrame:
    """Ids of the later sets of the pairs whose sets are similar; ``some`` (id, doc, line_no, keys) has at least the sets named."""
    a = some.select("id", F.struct("doc", "line_no", "id").alias("place"), F.col("keys").alias("a"))
    b = some.select(F.col("id").alias("other"), F.struct("doc", "line_no", "id").alias("place2"), F.col("keys").alias("b"))
    close = pairs.join(a, "id").join(b, "other").filter((NUM + DEN) * F.size(F.array_intersect("a", "b")) >= NUM * (F.size("a") + F.size("b")))
    return stage(close.select(F.greatest("place", "place2")["id"].alias("id")).distinct(), "verified")
