import random

from lodestone.catalog import load
from lodestone.llm import queries
from lodestone.llm.line_dedup import dedup_lines


def word_set(line):
    import re

    return frozenset(w for w in re.split(r"[ \t-\r]+", line.lower()) if w)


def brute(docs):
    """What stays of each (doc_id, text): every line against all earlier ones."""
    lines = [(i if i is not None else 1 << 63, no, line) for i, t in docs if t is not None for no, line in enumerate(t.split("\n"))]
    lines.sort()
    earlier, gone = [], set()
    for i, no, line in lines:
        s = word_set(line)
        if s:
            if any(5 * min(len(s), len(t)) >= 4 * max(len(s), len(t)) and 9 * len(s & t) >= 4 * (len(s) + len(t)) for t in earlier):
                gone.add((i, no))
            earlier.append(s)
    return {
        i: t if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if (i if i is not None else 1 << 63, no) not in gone) for i, t in docs
    }


def test_equals_brute_force_on_documents(spark, data):
    docs = [(r.doc_id, r.text) for r in load(spark, data, "documents").collect()]
    got = {r.doc_id: r.text for r in queries.QUERIES["op7_line_dedup"](spark, data).collect()}
    assert got == brute(docs) and any(got[i] != t for i, t in docs)


def test_equals_brute_force_on_near_copies(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 25))] for _ in range(12)]
    docs = []
    for i in range(150):
        lines = []
        for words in rng.sample(base, 4):
            words = list(words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rng.shuffle(words)
            lines.append(rng.choice([" ", "\t", "  "]).join(words))
        docs.append((i, rng.choice(["\n", "\n\n", "\n \n"]).join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_lines(df).collect()} == brute(docs)


def test_cases(spark):
    rows = [(3, "a b c d e\n\nx"), (1, None), (2, ""), (None, "x\nnew line"), (4, "y " * 50_000 + "\nA b  c d E"), (4, "other"), (5, "z\nz"), (5, "z\nz"), (6, " \n")]
    df = spark.createDataFrame([(i, t, "k", 7) for i, t in rows], "doc_id long, text string, line string, copy int")
    got = sorted(((r.doc_id or 0, r.text or "", r.line, r.copy) for r in dedup_lines(df).collect()))
    assert got == sorted(
        (i or 0, t or "", "k", 7)
        for i, t in [(3, "a b c d e\n\nx"), (1, None), (2, ""), (None, "new line"), (4, "y " * 50_000), (4, "other"), (5, "z"), (5, "z"), (6, " \n")]
    )
    assert dedup_lines(df.limit(0)).count() == 0 and dedup_lines(df).columns == df.columns


def test_equals_brute_force_on_long_lines(spark):
    """Lines on both sides of where sets are dealt into more classes, a group of near copies among them."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(20_000)]
    base = [rng.sample(vocabulary, n) for n in (50, 66, 79, 80, 81, 99, 130, 318, 322, 400, 1281, 5200)]
    docs = []
    for i in range(120):
        lines = []
        for words in rng.sample(base, 3):
            words = words[: rng.choice([len(words), len(words), int(len(words) * rng.uniform(0.75, 1))])]
            changed = set(rng.sample(range(len(words)), int(len(words) * rng.choice([0, 0.02, 0.05, 0.1, 0.12]))))
            lines.append(" ".join(rng.choice(vocabulary) if k in changed else w for k, w in enumerate(words)))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert {r.doc_id: r.text for r in dedup_lines(df).collect()} == want
    assert 0.1 < sum(len(t) for t in want.values()) / sum(len(t) for _, t in docs) < 0.9


def border_pairs(pools, rng, shares):
    """Two sets of keys for each of ``shares``, dealt to four classes: (in common, only in the first, only in the second) by class."""
    for share in shares:
        both, first, second = [], [], []
        for pool, (o, a, b) in zip(pools, share):
            words = rng.sample(pool, o + a + b)
            both, first, second = both + words[:o], first + words[o : o + a], second + words[o + a :]
        yield both + first, both + second


#: 79 and 80 keys, 71 in common: the smaller set's part is the larger one in the only class that is similar, and its own keys are rare.
ONE_CLASS = [(26, 4, 0), (15, 1, 3), (15, 1, 3), (15, 2, 3)]


def test_parts_of_a_smaller_set_may_be_the_larger_ones(spark):
    """Pairs on both sides of a class border, with the keys that aren't common in one class."""
    rng = random.Random(5)
    from pyspark.sql import functions as F

    words = spark.range(60_000).select(F.concat(F.lit("w"), "id").alias("w")).select("w", F.xxhash64("w").bitwiseAND(F.lit(3)).alias("c")).collect()
    pools = [[r.w for r in words if r.c == c] for c in range(4)]
    shares = [ONE_CLASS] * 40
    while len(shares) < 80:
        o = [rng.randint(10, 30) for _ in range(4)]
        k = rng.randrange(4)
        share = [(o[j], rng.randint(1, 5) if j == k else rng.randint(0, 2), 0 if j == k else rng.randint(0, 4)) for j in range(4)]
        n, m, common = sum(x + a for x, a, _ in share), sum(x + b for x, _, b in share), sum(o)
        if n < 80 <= m and 9 * common >= 4 * (n + m):
            shares.append(share)
    lines = [" ".join(s) for pair in border_pairs(pools, rng, shares) for s in pair]
    docs = list(enumerate(lines))
    rng.shuffle(lines)
    docs += [(1000 + i, x) for i, x in enumerate(lines[:20])]
    want = brute(docs)
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and sum(t == "" for t in want.values()) >= 100


def test_parts_meet_where_sets_are_dealt_into_classes(spark):
    """159 and 160 keys, 142 in common, similar in one class only: the smaller set enters by both class counts, the larger one in parts."""
    rng = random.Random(8)
    from pyspark.sql import functions as F

    from lodestone.llm import set_join

    assert set_join.class_count(159) == 1 < set_join.class_count(160) == 4
    words = spark.range(60_000).select(F.concat(F.lit("w"), "id").alias("w")).select("w", F.xxhash64("w").bitwiseAND(F.lit(3)).alias("c")).collect()
    pools = [[r.w for r in words if r.c == c] for c in range(4)]
    lines = [" ".join(s) for pair in border_pairs(pools, rng, [[(52, 8, 0), (30, 3, 6), (30, 3, 6), (30, 3, 6)]] * 40) for s in pair]
    docs = list(enumerate(lines))
    want = brute(docs)
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and sum(t == "" for t in want.values()) == 40
