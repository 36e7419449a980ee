import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from lodestone.llm import divergence, queries, words


def terms_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, least=30, top=50):
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lang, source, t = lang or "", source or "", terms_of(text)
        groups[lang].add(source)
        df[lang].update(set(t))
        count[lang, source].update(t)
        count[lang, None].update(t)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        share = {}
        for s in [None, *sources]:
            c = count[lang, s]
            total = sum(c[t] for t in kept) + 5 * len(kept)
            share[s] = {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}
        for s in sources:
            pair = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            term = [(share[None][t] - share[s][t], t.encode()) for t in kept if count[lang, s][t] and share[s][t] > share[None][t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(items)[:most])]
    return sorted(out)


def rows(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def made_docs(rng, many, sources=23):
    vocabulary = ["Red", "green", "BLUE", "été", "日本", "x", "of", "İz", "tail"] + [f"w{chr(97 + k)}" for k in range(20)]
    docs = []
    for _ in range(many):
        s = rng.randrange(sources)
        own = vocabulary[s % 7 :: 2] if s % 3 else vocabulary
        text = "".join(rng.choice(own) + rng.choice([" ", "-", "1", "_", "\n", "\0", ", "]) for _ in range(rng.randint(0, 40)))
        docs.append((rng.choice(["en", "en", "en", "de", None]), f"s{s}" if s else None, text))
    return docs + [("en", "silent", None), ("en", "silent", " 12 "), ("zz", "a", "only once"), ("zz", "b", None), ("alone", "a", "x"), ("en", "S", "red " * 20_000)]


def test_equals_brute_force(spark, monkeypatch):
    docs = made_docs(random.Random(1), 700)
    df = spark.createDataFrame([(*d, 1, "y") for d in docs], "lang string, source string, text string, value int, term string")
    want = brute(docs)
    assert rows(divergence.audit_sources(df)) == want and {r[2] for r in want} == {"pair", "term"}
    # Many slices of a few terms, two sources a block, and as many rounds as that takes.
    monkeypatch.setattr(divergence, "CELLS", 12)
    monkeypatch.setattr(divergence, "LEAST_IN_BLOCK", 2)
    assert rows(divergence.audit_sources(df, least_docs=10, top=3)) == brute(docs, 10, 3)
    assert divergence.audit_sources(df.limit(0)).count() == 0


def test_sql_equals_brute_force(spark, tmp_path):
    docs = made_docs(random.Random(2), 400, 9)
    spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, lang string, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({queries.DIVERGENCE_SQL})").fetchall()
    assert rows(queries.QUERIES["op13_source_divergence"](spark, str(tmp_path))) == sorted(want) == brute(docs)


def test_all_blocks_meet_once():
    for blocks in range(1, 18):
        met = Counter(tuple(sorted(p)) for visits in divergence.rounds(blocks) for p in visits.items())
        assert met == Counter({(a, b): 1 for b in range(blocks) for a in range(b)})
        for visits in divergence.rounds(blocks):
            assert len({*visits, *visits.values()}) == 2 * len(visits)


def test_shares_are_exact():
    rng = random.Random(3)
    for _ in range(300):
        counts = [rng.randrange(rng.choice([3, 10**6, 10**14])) for _ in range(rng.randint(1, 40))]
        total = sum(counts) + 5 * len(counts)
        assert divergence.shares(np.array(counts), total).tolist() == [1 + 10**9 * (c + 5) // total for c in counts]
    assert divergence.shares(np.array([0]), 5).tolist() == [10**9 + 1] and len(divergence.shares(np.array([], np.int64), 0)) == 0


def test_a_long_text_is_one_document(monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 7)
    raw = " ".join(["red", "blue", "red", "été"] * 30).encode()
    terms, counts, docs, _ = divergence._terms([raw], np.array([0]))
    assert dict(zip(terms.to_pylist(), counts.tolist())) == {"red": 60, "blue": 30, "été": 30} and set(docs.tolist()) == {1}


def test_counts_are_packed_and_unpacked():
    rng = random.Random(4)
    for _ in range(50):
        cells = [{"at": k, "n": rng.randrange(1, 1 << 50)} for k in rng.sample(range(90), rng.randint(0, 60))]
        assert divergence._unpack(divergence._pack(cells), 90).tolist() == [next((c["n"] for c in cells if c["at"] == k), 0) for k in range(90)]
