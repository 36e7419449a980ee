import random
import re
from collections import Counter
from itertools import pairwise

import duckdb

from lodestone.llm import collocations, queries, words


def plain_words(text):
    """The words of each piece."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", lower)]


def brute(docs, most=3, least=10, percent=50, top=2000):
    counts, total = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in plain_words(text or ""):
            total[lang] += len(piece)
            f.update(tuple(piece[i : i + n]) for n in range(1, most + 1) for i in range(len(piece) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {q[i : i + n] for q, b in candidates.items() for n in range(2, len(q)) for i in range(len(q) - n + 1) if 100 * b >= percent * f[q[i : i + n]]}
        rows = []
        for p, a in candidates.items():
            if p not in hidden:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made_docs(rng, many=120):
    vocabulary = ["New", "york", "city", "of", "the", "É", "a", "b", "c-d", "日本", "\x01x", "n b"]
    ends = [" ", "  ", "\t", " ", " ", ". ", ",", "\n", "!", "\r\n", ""]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randint(0, 90)))
    return [(rng.choice(["en", "en", "de", None, ""]), text()) for _ in range(many)] + [("en", None), (None, ""), ("xx", " . "), ("und", "a b a b " * 30)]


def test_equals_brute_force(spark):
    docs = made_docs(random.Random(1)) * 2
    df = spark.createDataFrame([(t, g, "z", 1) for g, t in docs], "text string, lang string, phrase string, count int")
    assert rows(collocations.collocations(df)) == brute(docs)
    assert rows(collocations.collocations(df, most=5, least=3, percent=70, top=7)) == brute(docs, 5, 3, 70, 7)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_sql_equals_brute_force(spark, tmp_path):
    docs = made_docs(random.Random(2), 400)
    spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(docs)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = rows(queries.QUERIES["op11_collocations"](spark, str(tmp_path)))
    want = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({queries.COLLOCATION_SQL})").fetchall()
    assert got == sorted(want) == brute(docs) and len(got) > 40, len(got)


def test_blocks_of_long_texts_count_each_ngram_once(monkeypatch):
    rng = random.Random(3)
    for size in (1, 5, 40):
        monkeypatch.setattr(words, "BLOCK", size)
        for _ in range(60):
            text = "".join(rng.choice(["ab", "c", "é", " ", "  ", ". ", "\n", " x "]) for _ in range(rng.randint(0, 60)))
            got = Counter()
            fresh = 0
            for block in collocations.SPLITTER.blocks(text.encode(), 3):
                fresh += len(block.starts) - block.old
                for n in range(1, 5):
                    at = collocations._ngrams(block, n)
                    got.update(words.slices(block.data, block.starts[at], block.ends[at + n - 1]).to_pylist())
            pieces = plain_words(text)
            want = Counter(" ".join(p[i : i + n]) for p in pieces for n in range(1, 5) for i in range(len(p) - n + 1))
            assert got == want and fresh == sum(map(len, pieces))


def test_hashes_tell_words_and_phrases_apart():
    text = " ".join(f"w{i} {i}w" for i in range(20_000))
    block = collocations.SPLITTER.split(text.encode())
    hashed = words.hashes(block)
    assert len(set(hashed.tolist())) == 40_000
    keys = [k for lang in ("en", "de") for n in (1, 2, 3) for k in collocations._keys(hashed, collocations._ngrams(block, n), n, words.seed(lang)).tolist()]
    assert len(set(keys)) == len(keys)
    again = collocations.SPLITTER.split(("x " + text[:90_000]).encode())
    assert words.hashes(again)[1:-1].tolist() == hashed[: len(again.starts) - 2].tolist()


def test_products_beyond_64_bits(spark, monkeypatch):
    counts = [("en", 0, "", 10**16), ("en", 1, "a", 4 * 10**15), ("en", 1, "b", 3 * 10**15), ("en", 2, "a b", 2 * 10**15 + 1)]
    df = spark.createDataFrame(counts, "lang string, size int, phrase string, count long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a: df)
    a = 2 * 10**15 + 1
    assert rows(collocations.collocations(df)) == [("en", 1, "a b", a, 4 * 10**15, 3 * 10**15, 10**16, 10**6 * a * a // (12 * 10**30))]


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = made_docs(random.Random(4), 40)
    df = spark.createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(collocations.bloom, "bits_for", lambda n: collocations.bloom.BUCKET_BITS)
    assert rows(collocations.collocations(df, least=2)) == brute(docs, least=2)


def test_ties_are_ranked_by_bytes(spark):
    docs = [("en", "é z. b c. a b. Z y.")] * 12
    got = rows(collocations.collocations(spark.createDataFrame(docs, "lang string, text string")))
    assert [r[2] for r in got] == ["a b", "b c", "z y", "é z"]
    assert got == brute(docs)
    assert all(a[7] >= b[7] for a, b in pairwise(got))
