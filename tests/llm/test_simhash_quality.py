import re

import numpy as np
import pytest

from lodestone.catalog import load
from lodestone.llm import quality, queries, simhash
from lodestone.llm.graph import components


def brute_fingerprint(text):
    xxhash = pytest.importorskip("xxhash")
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fps: (id, fingerprint); the smallest id that links reach."""
    ids, x = [i for i, _ in fps], np.array([f for _, f in fps], np.uint64)
    parent = list(range(len(x)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for k in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[k + 1 :] ^ x[k]) <= 4):
            parent[find(k + 1 + int(j))] = find(k)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: least[find(k)] for k, i in enumerate(ids)}


def test_simhash_equals_brute_force(spark, data):
    rows = [(r.doc_id, brute_fingerprint(r.text or "")) for r in load(spark, data, "documents").collect()]
    want = brute_components(rows)
    got = queries.QUERIES["op10_simhash"](spark, data).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in rows}
    assert {r.doc_id: r.component_id for r in got} == want


def test_kept_rows_where_ids_repeat_or_are_missing(spark):
    rows = [(1, None), (2, ""), (2, "x"), (2, "x"), (None, "a b c"), (None, "a b c"), (None, "d e f"), (3, "d e f"), (3, "g"), (4, "g"), (4, "x"), (4, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 9, r.text) for r in simhash.keep_first(df).collect() if r.text)
    assert got == [(2, "x"), (3, "d e f"), (3, "g"), (4, "h"), (9, "a b c")] and simhash.keep_first(df).count() == 6
    assert [r.doc_id for r in simhash.keep_first(df).filter("text IS NULL").collect()] == [1]
    assert simhash.keep_first(df.limit(0)).count() == 0


def test_texts_that_share_an_id_are_kept_or_go_each_by_itself(spark):
    alpha, one, red = "alpha beta gamma delta epsilon zeta eta", "one two three four five six seven", "red green blue yellow black white grey"
    df = spark.createDataFrame([(1, ""), (2, ""), (2, alpha), (2, alpha), (5, one), (5, red)], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.keep_first(df).collect()) == [(1, ""), (2, alpha), (5, one), (5, red)]


def test_near_copies_beyond_four_bits_go(spark):
    rng = np.random.default_rng(4)
    rows = []
    for base in range(40):
        words = [f"w{base}x{k}" for k in range(int(rng.integers(6, 300)))]
        for _ in range(int(rng.integers(1, 6))):
            copy = list(words)
            for k in rng.integers(0, len(words), int(len(words) * rng.random() * 0.06)):
                copy[k] = f"other{rng.integers(1000)}"
            rows.append(" ".join(copy))
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows)]
    least = brute_components([(i, brute_fingerprint(t)) for i, t in sorted(rows)])
    shingles = lambda t: {tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))}
    sets = [(i, shingles(t)) for i, t in sorted(rows)]
    near = {i for k, (i, a) in enumerate(sets) for _, b in sets[:k] if 5 * len(a & b) >= 4 * len(a | b)}
    want = sorted(set(least.values()) - near)
    assert len(want) < len(set(least.values()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_first(df).collect()) == want


def test_parts_of_sets_across_a_class_border_meet():
    """The 79 and 80 keys of the lines' test, as parts of shingle sets: the smaller part's short prefix has a key of the other's prefix."""
    import random

    from lodestone.llm import set_join
    from tests.llm.test_line_dedup import ONE_CLASS, border_pairs

    rng = random.Random(6)
    pools = [[(rng.getrandbits(62) << 2) | c for _ in range(400)] for c in range(4)]
    short = lambda n: n - -(-n * 2 * set_join.NUM // (set_join.NUM + set_join.DEN)) + 1
    for own, other in border_pairs(pools, rng, [ONE_CLASS] * 200):
        common = {h >> 48 for h in set(own) & set(other)}
        classes = np.array([9 if k in common else 1 for k in range(1 << 16)], np.uint8)
        a, b = ([p for p in simhash.dealt(np.sort(np.array(s, np.uint64)), classes)] for s in (own, other))
        met = False
        for _, count, n, odd, p, _ in a:
            for _, count2, m, odd2, q, _ in b:
                if count == count2 and 9 * ((odd ^ odd2) & (1 << 64) - 1).bit_count() <= n + m:
                    p2, q2 = (p[: short(n)], q) if n <= m else (p, q[: short(m)])
                    met |= bool(set(p2.tolist()) & set(q2.tolist()))
        assert met


def test_parities_tell_far_copies_of_a_large_group():
    """Sets around one text, most at a Jaccard of about 0.7 of each other: few of those pairs pass, and similar ones all do."""
    rng, classes = np.random.default_rng(3), np.ones(1 << 16, np.uint8)
    wide = lambda x: (x >> 64).bit_count() + ((x >> 64) ^ (x & (1 << 64) - 1)).bit_count()
    for size, changed in ((70, 12), (100, 17)):
        base = rng.integers(0, 1 << 63, size).astype(np.uint64)
        made = []
        for k in [changed] * 80 + [changed // 5] * 30:
            keys = base.copy()
            keys[rng.permutation(size)[:k]] = rng.integers(0, 1 << 63, k).astype(np.uint64)
            made.append((set(keys.tolist()), list(simhash.dealt(np.sort(keys), classes))))
        passed = {True: [], False: []}
        for i, (a, parts) in enumerate(made):
            for b, others in made[:i]:
                similar = 9 * len(a & b) >= 4 * (len(a) + len(b))
                # Parts come in order of class, and none is empty here.
                by_class = [(p, q) for p, q in zip(parts, others) if p[1] == q[1]]
                passed[similar].append(any(9 * wide(p[3] ^ q[3]) <= p[2] + q[2] for p, q in by_class))
        assert all(passed[True]) and len(passed[True]) > 400
        assert np.mean(passed[False]) < 0.15, (size, np.mean(passed[False]))


def test_links_of_dense_and_far_fingerprints(spark):
    rng = np.random.default_rng(0)
    made = set()
    for base in rng.integers(0, 2**63, 30):
        for _ in range(25):
            y = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 7)):
                y ^= 1 << int(k)
            made.add(y)
    rows = [(i, f) for i, f in enumerate(sorted(made))]
    signed = [(f - (1 << 64) if f >> 63 else f,) for _, f in rows]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    parent = {f: f for (f,) in signed}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for u, v in edges:
        parent[find(u)] = find(v)
    want = brute_components(rows)
    groups = {}
    for (i, _), (f,) in zip(rows, signed):
        groups.setdefault(find(f), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_simhash_cases(spark):
    rows = [(4, None), (3, "  \n"), (2, "A b"), (7, "a  B"), (None, "a b"), (2, "A b"), (9, "w " * 100_000), (None, "only here one two three")]
    df = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, fingerprint string, fp int")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()]
    assert sorted((i or -1, c or -1) for i, _, c in got) == [(-1, -1), (-1, 2), (2, 2), (2, 2), (3, 3), (4, 3), (7, 2), (9, 9)]
    assert {f for i, f, _ in got if i in (3, 4)} == {"0" * 16}
    assert sorted(r.doc_id or -1 for r in simhash.keep_first(df).collect()) == [-1, 2, 3, 9]
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(5, 5), (7, 7), (1, 0)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {k: 1000 for k in range(1000, 1400)}
    assert components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


def test_quality_on_the_held_out_fold(spark):
    data = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in load(spark, data, "labels").collect()}
    got = queries.QUERIES["op1_quality"](spark, data).collect()
    import zlib

    assert len(got) == load(spark, data, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.93 * len(unseen)
    assert sum(r.predicted for r in unseen if truth[r.doc_id]) >= 0.96 * sum(truth[r.doc_id] for r in unseen)


def test_every_score_equals_a_plain_walk_over_the_statistics(spark, data):
    import zlib

    trees = quality.train(load(spark, data, "documents"), load(spark, data, "labels"))
    texts = {r.doc_id: r.text or "" for r in load(spark, data, "documents").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op1_quality"](spark, data).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        x, total = quality.statistics(text), trees.prior
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if x[trees.feature[node]] <= trees.limit[node] else trees.right[node]
            total += trees.value[node]
        want = 1 / (1 + np.exp(-total))
        assert got[i].score == pytest.approx(want, abs=1e-9) and got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].predicted == int(got[i].score >= 0.7)


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    rows = [(1, f"text number {i} " * 30) for i in range(50)] + [(2, "x"), (3, "y y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    seen = []
    import lodestone.llm.quality as module

    plain, module.fit = module.fit, lambda x, y: seen.append((x, y)) or plain(x, y)
    try:
        module.train(df, labels)
    finally:
        module.fit = plain
    kept = [i for i in (1, 2, 3) if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    assert len(seen[0][0]) == len(kept)


def test_flat_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    t = quality.fit(x, y, rounds=30)
    for i in range(40):
        total = t.prior
        for node in t.roots:
            while t.left[node] != node:
                node = t.left[node] if x[i, t.feature[node]] <= t.limit[node] else t.right[node]
            total += t.value[node]
        assert abs(1 / (1 + np.exp(-total)) - t.scores(x[i : i + 1])[0]) < 1e-12
    assert ((t.scores(x) > 0.5) == (y > 0)).mean() > 0.95


def test_quality_cases(spark):
    rows = [(1, None), (None, "a b"), (1, ""), (3, "x" * 200_000), (4, "\ud83d ok".encode("utf-16", "surrogatepass").decode("utf-16", "replace"))]
    df = spark.createDataFrame([(i, t, 0.5, "q") for i, t in rows], "doc_id long, text string, score double, x string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None)], "doc_id long, quality int")
    one_class = quality.train(df, labels)
    assert quality.score(df, one_class).count() == 5
    nothing = quality.train(df, labels.limit(0))
    assert {r.score for r in quality.score(df, nothing).collect()} == {1.0}
    assert quality.accepted(df, nothing).columns == df.columns and quality.accepted(df, nothing).count() == 5
    assert quality.score(df.limit(0), nothing).count() == 0
