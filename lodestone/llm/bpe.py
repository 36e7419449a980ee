"""Exact byte-pair encoding, by merge rounds over all new words of a batch and by prefixes in long ones, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow import map_batches, texts
from lodestone.llm.merges import Merges

#: Fixed values of the vocabulary's file format: the word pattern's classes and Unicode's white space.
SPACES = "\t-\r \x85\xa0  -     　"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")
#: Most stretches: one word of plain letters, perhaps with marks behind it, as the pattern would cut it.
PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([,.:;!?]*)")
SPLIT = regex.compile(f"[{SPACES}]+")
#: White space for Python's split() but not for the pattern.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
END = "</w>"


def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies show for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]

#: Characters of the longest word or stretch that is kept for its next occurrence.
LONGEST_KEPT = 120
#: Stretches that wait to be encoded together.
WAITING = 1 << 18
COUNT, IDS, SHOWN = (itemgetter(k) for k in range(3))


class WordBPE:
    """A vocabulary of words with an end mark.

    A word is a string of symbols, one for each byte, of which the last is marked as the word's end. The words of
    all stretches of a batch that aren't known yet are merged together (:class:`Merges`).

    In a long stretch, where rounds could be many, a word is encoded by its prefixes.
    For every prefix of it exactly one token can come last in the prefix's encoding: a token that ends
    there, that merging really forms, and that is compatible with the last token of the prefix before
    it. An automaton gives all tokens ending at each place, and back-pointers give the ids.
    """

    def __init__(self, path: str, cache: int = 100_000):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["end_of_word_suffix"] != END or spec["decoder"] is not None:
            raise ValueError("not a vocabulary of words with end marks")
        self.token_ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.token_ids.items(), *self.special.items()]}
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.formed: dict[tuple[int, int], int] = {}
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, token = (self.token_ids[left], self.token_ids[right]), self.token_ids[left + right]
            self.rank[pair], self.formed[pair], self.parts[token] = r, token, pair
        self.order = {token: self.rank[pair] for token, pair in self.parts.items()}
        chars = byte_chars()
        place = {c: i for i, c in enumerate(chars)}
        self.plain, self.final = chars, [chr(0xE000 + b) for b in range(256)]
        self.automaton = ahocorasick.Automaton()
        for token, i in self.token_ids.items():
            ends = token.endswith(END) and token != END
            body = token[: -len(END)] if ends else token
            if all(c in place for c in body) and body:
                symbols = body[:-1] + self.final[place[body[-1]]] if ends else body
                self.automaton.add_word(symbols, (i, len(symbols)))
        self.automaton.make_automaton()
        self.symbols = {i: s for s, (i, _) in self.automaton.items()}
        self.single = {s: i for i, s in self.symbols.items() if len(s) == 1}
        self.merges = Merges((left << 32 | right, r, self.formed[left, right]) for (left, right), r in self.rank.items())
        self.plain_ids, self.final_ids = (np.array([self.single[c] for c in x], np.int32) for x in (self.plain, self.final))
        # What ids are shown as, each with a space behind it.
        shown = [f"{self.names.get(i, '')} ".encode() for i in range(max(self.names) + 1)]
        self.shown_size = np.array([len(x) for x in shown])
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.shown_data = np.frombuffer(b"".join(shown), np.uint8)
        self.limit = cache
        self.sound: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        # Two generations each: when the young one is full it becomes the old one, and what is asked again moves back.
        self.words: dict[str, list[int]] = {}
        self.old_words: dict[str, list[int]] = {}
        self.chunks: dict[str, tuple[int, bytes, bytes]] = {}
        self.old_chunks: dict[str, tuple[int, bytes, bytes]] = {}
        self.long: Iterable[str] = ()

    def merged(self, ids: list[int]) -> list[int]:
        """Plain merging, lowest rank first and leftmost among equals; for single tokens and tests."""
        ids = list(ids)
        while len(ids) > 1:
            best, at = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(ids, ids[1:])))
            if best == 1 << 60:
                break
            ids[at : at + 2] = [self.formed[ids[at], ids[at + 1]]]
        return ids

    def is_sound(self, token: int) -> bool:
        """Whether merging the token's own symbols gives the token."""
        known = self.sound.get(token)
        if known is None:
            known = self.sound[token] = self.merged([self.single[c] for c in self.symbols[token]]) == [token]
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side: at no time does a merge across their border come first.

        Going back in time, the token that was formed later falls into its parts, and the parts next to
        the border are looked at. Of merges of equal rank the leftmost comes first, so a merge across the
        border also beats an equal one on its right.
        """
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 2 * self.limit:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        before = 1 << 60
        while True:
            if self.rank.get((left, right), 1 << 60) < before:
                return False
            a, b = self.order.get(left, -1), self.order.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, self.parts[left][1]
            else:
                before, right = b + 1, self.parts[right][0]

    def encode_word(self, word: str) -> list[int]:
        if len(word) > LONGEST_KEPT:
            return self._encode_word(word)
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.words) >= self.limit // 2:
            self.words, self.old_words = {}, self.words
        ids = self.words[word] = self.old_words.get(word) or self._encode_word(word)
        return ids

    def _encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        symbols = "".join([self.plain[b] for b in raw[:-1]]) + self.final[raw[-1]]
        last = [-1] * (len(raw) + 1)
        size = [0] * (len(raw) + 1)
        for at, (token, n) in self.automaton.iter(symbols):
            if last[at + 1] < 0 and self.is_sound(token):
                before = at + 1 - n
                if not before or (last[before] >= 0 and self.compatible(last[before], token)):
                    last[at + 1], size[at + 1] = token, n
        ids, at = [], len(raw)
        while at:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids

    def _encode_chunk(self, chunk: str) -> tuple[int, bytes, bytes]:
        ids = [i for word in WORDS.findall(chunk) for i in self.encode_word(word)]
        return len(ids), _little_endian(ids), self.decode(ids).encode("utf-8")

    def encode_chunks(self, chunks: list[str]) -> list[tuple[int, bytes, bytes]]:
        """(number of ids, ids as little-endian 32-bit integers, their text in UTF-8) of each stretch."""
        words, many = [], []
        for chunk in chunks:
            m = PLAIN.fullmatch(chunk)
            found = WORDS.findall(chunk) if m is None else m.groups() if m[2] else (chunk,)
            words += found
            many.append(len(found))
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(r) for r in raws])
        data, ends = np.frombuffer(b"".join(raws), np.uint8), np.cumsum(size) - 1
        symbol = self.plain_ids[data]
        symbol[ends] = self.final_ids[data[ends]]
        symbol, word, _ = self.merges.merged(symbol, np.repeat(np.arange(len(words), dtype=np.int32), size))
        shown = self.shown_size[symbol]
        places = np.arange(shown.sum()) + np.repeat(self.shown_at[symbol] - np.cumsum(shown) + shown, shown)
        ids, text = symbol.astype("<u4").tobytes(), self.shown_data[places].tobytes()
        bounds = np.searchsorted(word, np.concatenate(([0], np.cumsum(many))))
        text_bounds = np.concatenate(([0], np.cumsum(shown)))[bounds].tolist()
        bounds = bounds.tolist()
        return [(b - a, ids[4 * a : 4 * b], text[c : d - 1]) for a, b, c, d in zip(bounds, bounds[1:], text_bounds, text_bounds[1:])]

    def learn(self, lists: Iterable[list[str]]) -> None:
        """Put all stretches of the lists into ``chunks``."""
        missing = set().union(*lists).difference(self.chunks)
        if self.old_chunks:
            known = {c: self.old_chunks[c] for c in missing.intersection(self.old_chunks)}
            self.chunks.update(known)
            missing.difference_update(known)
        new = [c for c in missing if len(c) <= LONGEST_KEPT]
        if new:
            self.chunks.update(zip(new, self.encode_chunks(new)))
        self.long = missing.difference(new) if len(new) < len(missing) else ()
        for c in self.long:
            self.chunks[c] = self._encode_chunk(c)

    def forget(self) -> None:
        """Let go of long stretches, and start a new generation if there are many."""
        for c in self.long:
            self.chunks.pop(c, None)
        if len(self.chunks) > self.limit * 2:
            self.chunks, self.old_chunks = {}, self.chunks if len(self.chunks) <= self.limit * 4 else {}

    def _stretches(self, text: str) -> Iterator[list[str] | int]:
        """The text's stretches without white space, in lists of at most WAITING, and the ids of its special tokens."""
        for raw, special in self._sections(text):
            if special is not None:
                yield special
                continue
            clean = unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()
            odd = any(c in clean for c in SEPARATORS)
            chunks = [c for c in SPLIT.split(clean) if c] if odd else clean.split()
            for at in range(0, len(chunks), WAITING):
                yield chunks[at : at + WAITING]

    def _sections(self, text: str) -> Iterable[tuple[str, int | None]]:
        at = 0
        for m in self.special_pattern.finditer(text) if "<|" in text else ():
            yield text[at : m.start()], None
            yield "", self.special[m[0]]
            at = m.end()
        yield text[at:], None

    def encode_batch(self, batch: Iterable[str]) -> Iterator[tuple[int, bytes, bytes]]:
        """For each text: number of ids, the ids as little-endian unsigned 32-bit integers, the decoded text in UTF-8."""
        made: list[list[tuple[int, bytes, bytes]]] = []
        waiting: list[tuple[int, list[str]]] = []
        chunks = 0

        def settle():
            self.learn([x for _, x in waiting])
            for k, x in waiting:
                made[k] += map(self.chunks.__getitem__, x)
            waiting.clear()
            self.forget()

        for text in batch:
            made.append([])
            for x in self._stretches(text):
                if isinstance(x, int):
                    settle()
                    chunks = 0
                    made[-1].append((1, _little_endian([x]), self.names[x].encode("utf-8")))
                    continue
                waiting.append((len(made) - 1, x))
                chunks += len(x)
                if chunks >= WAITING:
                    settle()
                    chunks = 0
        settle()
        for pieces in made:
            yield sum(map(COUNT, pieces)), b"".join(map(IDS, pieces)), b" ".join(map(SHOWN, pieces))

    def encode_bytes(self, text: str) -> tuple[int, bytes, bytes]:
        return next(self.encode_batch([text]))

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_bytes(text)[1]).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' names joined by spaces, special tokens included."""
        return " ".join([self.names[i] for i in ids])


def _little_endian(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


_LOADED: dict[str, WordBPE] = {}


def tokenizer(path: str) -> WordBPE:
    """The vocabulary at ``path``, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBPE(path)
    return _LOADED[path]


#: What bpe_frame can make of each text: type and value of (count, ids, decoded).
OUTPUTS = {
    "n_tokens": ("long", lambda n, ids, decoded: n),
    "ids": ("array<int>", lambda n, ids, decoded: array("I", ids).tolist()),
    "decoded": ("string", lambda n, ids, decoded: decoded.decode("utf-8")),
    "ids_sha256": ("string", lambda n, ids, decoded: hashlib.sha256(ids).hexdigest()),
    "decoded_sha256": ("string", lambda n, ids, decoded: hashlib.sha256(decoded).hexdigest()),
}
ARROW_TYPES = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def bpe_frame(
    docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text and decode the ids: the id column and the chosen ``outputs``.

    No shuffle: each Arrow batch is encoded where it lies, all its new stretches together. ``path`` is the vocabulary's file, which
    each worker reads by itself. Caches of stretches, words and pairs are bounded, as long ones aren't kept, and only save time.

    Defined cases: a null text is the empty text, which has no ids and decodes to the empty text; ids may
    be null and rows may repeat; an empty table gives no rows; further columns are dropped.
    """
    kinds = [OUTPUTS[o] for o in outputs]

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = tokenizer(path)
        columns: list[list] = [[] for _ in kinds]
        for made in bpe.encode_batch(texts(batch.column(1))):
            for column, (_, value) in zip(columns, kinds):
                column.append(value(*made))
        arrays = [pa.array(c, ARROW_TYPES[t]) for c, (t, _) in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names=["doc_id", *outputs])

    schema = ", ".join(["doc_id long", *(f"{o} {t}" for o, (t, _) in zip(outputs, kinds))])
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), encode, schema)
