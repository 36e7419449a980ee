import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodestone.catalog import load
from lodestone.llm import mixing, queries, suffixes


def brute(raws, length):
    """For each text: bytes, removed bytes, runs, digest of what stays."""
    times = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if times[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        yield len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def test_suffix_order():
    rng = random.Random(0)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([1, 2, 300])) for _ in range(rng.randint(0, 60))]
        assert suffixes.suffix_order(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    huge = np.array([1 << 40, 3, 1 << 40, 3, 5, 1 << 50], np.int64)
    assert suffixes.suffix_order(huge).tolist() == sorted(range(6), key=lambda i: huge[i:].tolist())


def test_every_string_has_one_anchor_that_depends_on_it_only():
    rng = random.Random(1)
    seen = {}
    for _ in range(60):
        raw = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 300)))
        h, at, first, last = suffixes.anchors(raw, 40, 12)
        starts = [s for a, b in zip(first, last) for s in range(a, b + 1)]
        assert starts == list(range(max(0, len(raw) - 39)))
        for x, p, a, b in zip(h, at, first, last):
            for s in range(a, b + 1):
                assert seen.setdefault(raw[s : s + 40], (x, p - s)) == (x, p - s)


def check(spark, rows, length, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df, length=length, **more).collect())
    want = sorted((i, *b) for (i, _), b in zip(rows, brute([(t or "").encode() for _, t in rows], length)))
    assert got == want
    return got


def test_equals_brute_force_on_documents(spark, data):
    rows = [(r.doc_id, r.text) for r in load(spark, data, "documents").collect()]
    got = queries.QUERIES["op8_suffixes"](spark, data).collect()
    want = {i: b for (i, _), b in zip(rows, brute([(t or "").encode() for _, t in rows], 200))}
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and any(r.n_removed for r in got)


def test_equals_brute_force_on_shared_passages(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    shared = [" ".join(word() for _ in range(rng.randint(40, 120))) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for s in rng.sample(shared, rng.randint(0, 3)):
            a, b = sorted((rng.randint(0, len(s)), rng.randint(0, len(s))))
            parts += [s[a:b], " ".join(word() for _ in range(rng.randint(0, 30)))]
        rows.append((i, "".join(parts)))
    got = check(spark, rows, 200)
    assert sum(r[2] > 0 for r in got) > 5


def test_a_crowd_of_contexts_is_dealt_by_strings(spark, monkeypatch):
    """One passage in all documents, cut differently in each."""
    monkeypatch.setattr(suffixes, "CROWD", 5)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(150))
    rows = []
    for i in range(60):
        a, b = rng.randint(0, 150), rng.randint(350, len(passage))
        rows.append((i, " ".join(word() for _ in range(40)) + passage[a:b] + " ".join(word() for _ in range(40))))
    assert sum(r[2] > 0 for r in check(spark, rows, 200)) == 60


def test_cases(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(500))
    rows = [(1, None), (2, ""), (3, "x" * 199), (4, "x" * 205), (5, text), (5, text), (6, text[:250]), (7, "z" + text[100:299] + "y"), (8, "ab" * 3000)]
    got = check(spark, rows, 200)
    assert dict((r[0], r[2]) for r in got)[7] == 0
    df = spark.createDataFrame([(None, text, "k", 1), (9, text, "k", 2)], "doc_id long, text string, key string, start int")
    out = suffixes.remove_repeats(df, with_text=True).collect()
    assert [(r.n_removed, bytes(r.kept), [tuple(s) for s in r.spans]) for r in out] == [(500, b"", [(0, 500)])] * 2
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_pieces_of_long_texts(monkeypatch, spark):
    monkeypatch.setattr(suffixes, "POSITION_BITS", 24)
    raw = bytes(range(97, 123)) * 40
    most = 1 << 22
    assert [(a, len(p)) for a, p in suffixes.pieces(b"x" * (2 * most + 10), 200)] == [(0, most + 199), (most, most + 10)]
    assert list(suffixes.pieces(raw, 200)) == [(0, raw)]


def test_rates_meet_targets(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = load(spark, data, "documents"), load(spark, data, "labels")
    mixture = mixing.fit(docs, labels)
    rows = mixing.document_rates(docs, mixture).collect()
    assert len(rows) == docs.count() and min(r.rate for r in rows) >= 0
    p = np.array([[r[f"p_{d}"] for d in mixture.domains] for r in rows])
    tokens = np.array([r.tokens for r in rows], float)
    rate = np.array([r.rate for r in rows])
    assert np.allclose((tokens * rate) @ p, mixture.targets, rtol=1e-4)
    assert np.allclose(mixture.targets / mixture.targets.sum(), [mixing.WEIGHTS[d] for d in mixture.domains])
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    right = [mixture.domains[int(np.argmax(q))] == lang[r.doc_id] for q, r in zip(p, rows) if r.tokens > 5]
    assert np.mean(right) > 0.97
    assert {r.doc_id: r.tokens for r in rows} == {r.doc_id: len((r.text or "").encode().split()) for r in docs.collect()}
    mixed = mixing.mix(docs, mixture)
    copies = {r.doc_id: r.copies for r in rows}
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == Counter({i: n for i, n in copies.items() if n})


def test_descent_finds_the_least_squares_solution(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500)
    tokens = rng.integers(0, 900, 500)
    table = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens long, p array<double>")
    for weights, budget in (({"a": 0.7, "b": 0.2, "c": 0.1}, None), ({"a": 0.9, "b": 0.1, "c": 0.0}, float(tokens.sum()) * 0.3)):
        m = mixing.Mixture(["a", "b", "c"], np.zeros((3, mixing.BUCKETS)), np.zeros(3))
        mixing.fit_rates(table, m, weights, budget)
        r = m.rates(p)
        got = (tokens * r) @ p
        assert (r >= 0).all()
        if budget is None:
            assert np.allclose(got, m.targets, rtol=1e-4)
        else:
            inverse = np.linalg.inv((p * tokens[:, None]).T @ p)
            gradient = p @ (inverse @ (got - m.targets))
            assert np.abs(np.where(r > 0, gradient, np.minimum(gradient, 0))).max() < 0.02


def test_mixing_cases(spark):
    rows = [(1, None, "en"), (None, "the and of", None), (2, "", "de"), (2, "le la " * 50_000, "fr"), (2, "le la " * 50_000, "fr")]
    df = spark.createDataFrame([(*r, "z", 1.5) for r in rows], "doc_id long, text string, lang string, tokens string, rate double")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        out = mixing.document_rates(df, mixing.fit(df, some)).collect()
        assert len(out) == 5 and all(r.rate >= 0 and r.copies >= 0 for r in out)
        assert sorted(r.tokens for r in out) == [0, 0, 3, 100_000, 100_000]
    empty = mixing.fit(df.limit(0), labels)
    assert mixing.document_rates(df.limit(0), empty).count() == 0 and mixing.mix(df.limit(0), empty).columns == df.columns


def test_every_posterior_and_rate_equals_a_plain_version(spark, data):
    """Byte triples counted one by one, naive Bayes by its definition, and the descent step by step."""
    import math

    docs = load(spark, data, "documents").collect()
    labelled = {r.doc_id for r in load(spark, data, "labels").collect()}
    domains = sorted(mixing.WEIGHTS)

    def bucket(a, b, c):
        return ((((a << 16) | (b << 8) | c) * 2654435761) & 0xFFFFFFFF) >> 19

    counted = {}
    for r in docs:
        raw = (r.text or "").encode()
        counted[r.doc_id] = Counter(bucket(*raw[i : i + 3]) for i in range(len(raw) - 2))
    shares, prior = {}, {}
    for d in domains:
        own = [counted[r.doc_id] for r in docs if r.lang == d and r.doc_id in labelled]
        total = sum(own, Counter())
        every = sum(total.values()) + 0.5 * mixing.BUCKETS
        shares[d] = lambda b, total=total, every=every: math.log((total[b] + 0.5) / every)
        prior[d] = len(own) + 1
    p = {}
    for r in docs:
        n = sum(counted[r.doc_id].values())
        weigh = min(n, mixing.EVIDENCE) / n if n else 0
        z = {d: math.log(prior[d] / sum(prior.values())) + weigh * sum(k * shares[d](b) for b, k in counted[r.doc_id].items()) for d in domains}
        e = {d: math.exp(z[d] - max(z.values())) for d in domains}
        p[r.doc_id] = [round(e[d] / sum(e.values()), 9) for d in domains]
    got = {r.doc_id: r for r in queries.QUERIES["op6_mixing"](spark, data).collect()}
    assert set(got) == set(p)
    for i in p:
        assert [got[i][f"p_{d}"] for d in domains] == pytest.approx(p[i], abs=2e-9)

    ids = sorted(p)
    q, tokens = np.array([p[i] for i in ids]), np.array([len((r.text or "").encode().split()) for r in sorted(docs, key=lambda r: r.doc_id)], float)
    weights = np.array([mixing.WEIGHTS[d] for d in domains])
    goal = weights * ((tokens @ q) / weights).max()
    rate, inverse = np.ones(len(ids)), np.linalg.inv((q * tokens[:, None]).T @ q)
    for _ in range(mixing.MOST_STEPS):
        rate = np.maximum(0, rate - q @ (inverse @ ((tokens * rate) @ q - goal)))
    assert [got[i].rate for i in ids] == pytest.approx(rate, abs=2e-6)
    gap = np.abs((tokens * rate) @ q - goal).max() / goal.sum()
    assert all(abs(r.target_gap - gap) < 1e-6 for r in got.values())


def test_a_domain_without_documents_leaves_a_gap(spark):
    df = spark.createDataFrame([(i, "the and of " * 9, "en") for i in range(8)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, quality int")
    m = mixing.fit(df, labels, {"en": 0.5, "fr": 0.5})
    assert m.gap >= 0 and {round(r.target_gap, 9) for r in mixing.document_rates(df, m).collect()} == {round(m.gap, 9)}


def test_rows_without_id_draw_by_their_text(spark):
    rows = [(None, f"the and of {i}", "en") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = mixing.Mixture(["en"], np.zeros((1, mixing.BUCKETS)), np.zeros(1), steps=[np.array([0.5])])
    copies = [r.copies for r in mixing.document_rates(df, m).collect()]
    assert 100 < sum(copies) < 200


def test_row_keys_tell_all_rows_apart(spark, tmp_path):
    spark.range(1000).selectExpr("id AS doc_id", "'same' AS text").repartition(7).write.parquet(str(tmp_path / "t"))
    rows = suffixes.with_row_keys(spark.read.parquet(str(tmp_path / "t")))
    first = {r.doc_id: r.row_key for r in rows.collect()}
    assert len(set(first.values())) == 1000 and {k >> 40 for k in first.values()} == set(range(7)) and rows.columns == ["doc_id", "text", "row_key"]
    assert first == {r.doc_id: r.row_key for r in rows.filter("doc_id >= 0").repartition(3).collect()}
