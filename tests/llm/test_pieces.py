import hashlib
import random

import numpy as np
import pytest

from lodestone.catalog import load
from lodestone.llm import pieces, queries


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(path):
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=path)


@pytest.fixture(scope="module")
def own(path):
    return pieces.PieceBPE(path)


def same(own, library, texts):
    for t, (n, ids, decoded) in zip(texts, own.encode_batch(texts)):
        want = library.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want and n == len(want), t[:80]
        assert decoded.decode("utf-8") == own.decode(want) == library.decode(want), t[:80]


def test_query_equals_the_library(spark, data, library):
    texts = {r.doc_id: r.text or "" for r in load(spark, data, "documents").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op12_sentencepiece"](spark, data).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = library.encode(t, add_bos=True, add_eos=True)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode("utf-8")).hexdigest()


def test_made_texts_equal_the_library(own, library):
    rng = random.Random(1)
    signs = ["a", "b", "e", "t", "h", " ", "  ", "▁", "\n", "é", "日", "本", "😀", "\0", "=", "-", "0", "1", "ﬁ", "Ａ", "é"]
    same(own, library, ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(1500)])
    names = own.names[259:]
    same(own, library, ["".join(rng.choices(names, k=rng.randint(1, 40))) for _ in range(800)])
    plain = [n.replace("▁", "") for n in names if n.isascii() or n[0] == "▁"]
    same(own, library, ["".join(rng.choices(plain, k=rng.randint(1, 40))) for _ in range(1500)])
    same(own, library, [unit * n for unit in ("a", "ab", "the", "  ", "tion", "=-") for n in range(1, 70)])


def test_long_words_and_sections(own, library, monkeypatch):
    rng = random.Random(2)
    dense = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=60_000))
    rare = "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(30_000))
    same(own, library, [dense, rare, "e" * 200_000, "the quick  brown\nfox " * 20_000, "▁" * 5000 + "x"])
    monkeypatch.setattr(pieces, "BLOCK", 16)
    same(own, library, ["".join(rng.choices(["a", " ", "the", "日", "▁▁", "\t"], k=rng.randint(0, 120))) for _ in range(500)])


def test_what_is_kept_changes_nothing(own, library, path, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 5)
    small = pieces.PieceBPE(path)
    rng = random.Random(3)
    words = ["red", "green", "blueish", "walking", "  x", "zz"]
    for _ in range(60):
        same(small, library, [" ".join(rng.choices(words, k=3)) + "q" * 70 for _ in range(2)])
        assert len(small.words) <= 5 and len(small.old_words) <= 10


def test_decoding_any_ids(own, library):
    rng = random.Random(4)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, 3 + rng.randrange(256), 3 + 0xE6, 3 + 0x97, 3 + 0xA5, rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_frame_cases(spark, path):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, None, 6), (3, "", 7), (4, "x" * 300_000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id or 0, r.n_tokens, len(r.ids), r.decoded) for r in pieces.piece_frame(df, path).collect()))
    assert [g[0] for g in got] == [0, 1, 1, 3, 4] and got[0] == (0, 2, 2, "") and got[3] == (3, 2, 2, "") and got[1] == got[2] and got[4][3] == "x" * 300_000
    assert pieces.piece_frame(df.limit(0), path).count() == 0
