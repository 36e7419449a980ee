"""SentencePiece encoding by merge rounds over the symbols of many words, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow import map_batches, texts
from lodestone.llm.bpe import ARROW_TYPES, OUTPUTS
from lodestone.llm.merges import Merges

SPACE = "▁"
#: A word is a run of space marks and what follows it up to the next one. No piece goes on over a word's start.
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Characters whose words are encoded at a time, and where a long text may be cut: before the first space mark of a run.
BLOCK = 1 << 20
#: Longer words are cut where no piece has the two characters side by side, and aren't kept for their next occurrence.
LONGEST_KEPT = 64
#: Words that are kept: two generations of so many.
KEPT = 200_000
NEXT_WORD = re.compile(f"(?<=[^{SPACE}]){SPACE}")
FIRST, SECOND, THIRD = (itemgetter(k) for k in range(3))


class PieceBPE:
    """A vocabulary of pieces with scores and byte fallback.

    Encoding merges neighbours that are a piece together, best score first and leftmost among equals, until there are none.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        known = range(model.vocab_size())
        self.names = [model.id_to_piece(i) for i in known]
        self.control, self.unknown = {i for i in known if model.is_control(i)}, model.unk_id()
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.byte_ids = {int(self.names[i][3:5], 16): i for i in known if model.is_byte(i)}
        self.bytes = {i: bytes([b]) for b, i in self.byte_ids.items()}
        if len(self.byte_ids) != 256 or any(model.is_unused(i) for i in known):
            raise ValueError("not a vocabulary of pieces with byte fallback")
        if model.normalize(" a  bＡ ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}bＡ{SPACE}":
            raise ValueError("the vocabulary normalises its texts")
        normal = {self.names[i]: i for i in known if i not in self.control and i != self.unknown and i not in self.bytes}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("a piece goes on over the start of a word")
        scores = {p: model.get_score(i) for p, i in normal.items()}
        place = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        # Every symbol is a piece, or a character that no piece has.
        missing = {c for p in normal for c in p} - set(normal)
        self.no_char = len(self.names) + len(missing)
        symbols = normal | {c: len(self.names) + k for k, c in enumerate(sorted(missing))}
        self.char_ids = np.full(0x110000, self.no_char, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.char_ids[ord(s)] = i
        merges = [(symbols[p[:k]] << 32 | symbols[p[k:]], place[scores[p]], i) for p, i in normal.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        self.merges = Merges(merges)
        self.side_by_side = {p[k : k + 2] for p in normal for k in range(len(p) - 1)}
        self.shown = [self.bytes.get(i, n.replace(SPACE, " ").encode("utf-8")) for i, n in enumerate(self.names)]
        self.shown_size = np.array([len(x) for x in self.shown])
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.shown_data = np.frombuffer(b"".join(self.shown), np.uint8)
        self.id_of_byte = np.array([self.byte_ids[b] for b in range(256)], np.int32)
        self.long: list[str] = []
        self.words: dict[str, tuple[int, bytes, bytes]] = {}
        self.old_words: dict[str, tuple[int, bytes, bytes]] = {}

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The symbols left of all words, in order: symbol, word, first character; and the characters' codes."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        word = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
        return *self.merges.merged(self.char_ids[codes], word), codes

    def encode_words(self, words: list[str]) -> list[tuple[int, bytes, bytes]]:
        """(number of ids, ids as little-endian 32-bit integers, their text in UTF-8) of each word."""
        symbol, word, start, codes = self.merged(words)
        odd = np.flatnonzero(symbol >= len(self.names))
        if len(odd):
            # Characters that no piece has become the ids of their bytes.
            raws = [chr(c).encode("utf-8", "surrogatepass") for c in codes[start[odd]]]
            many = np.ones(len(symbol), np.int64)
            many[odd] = [len(r) for r in raws]
            symbol, word, ends = np.repeat(symbol, many), np.repeat(word, many), np.cumsum(many)
            symbol[np.concatenate([np.arange(ends[k] - len(r), ends[k]) for k, r in zip(odd, raws)])] = self.id_of_byte[list(b"".join(raws))]
        size = self.shown_size[symbol]
        places = np.arange(size.sum()) + np.repeat(self.shown_at[symbol] - np.cumsum(size) + size, size)
        ids, text = symbol.astype("<u4").tobytes(), self.shown_data[places].tobytes()
        bounds = np.searchsorted(word, np.arange(len(words) + 1))
        text_bounds = np.concatenate(([0], np.cumsum(size)))[bounds].tolist()
        bounds = bounds.tolist()
        return [(b - a, ids[4 * a : 4 * b], text[c:d]) for a, b, c, d in zip(bounds, bounds[1:], text_bounds, text_bounds[1:])]

    def parts(self, word: str) -> list[str]:
        """The word, or if it is long its parts, between which no merge is possible."""
        if len(word) <= LONGEST_KEPT:
            return [word]
        cuts = [0, *(k for k in range(1, len(word)) if word[k - 1 : k + 1] not in self.side_by_side), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def learn(self, lists: Iterable[list[str]]) -> None:
        """Put all words of the lists into ``words``."""
        missing = set().union(*lists).difference(self.words)
        if self.old_words:
            known = {w: self.old_words[w] for w in missing.intersection(self.old_words)}
            self.words.update(known)
            missing.difference_update(known)
        if missing:
            new = list(missing)
            self.words.update(zip(new, self.encode_words(new)))
            self.long += [w for w in new if len(w) > LONGEST_KEPT]

    def forget(self) -> None:
        """Let go of long words, and start a new generation of words if there are many."""
        for w in self.long:
            self.words.pop(w, None)
        self.long = []
        if len(self.words) > KEPT:
            self.words, self.old_words = {}, self.words if len(self.words) <= 2 * KEPT else {}

    def sections(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """The words' parts of the text, in lists of about BLOCK characters, with their number of characters."""
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        at = 0
        while at < len(marked):
            to = len(marked)
            if to - at > BLOCK:
                cut = NEXT_WORD.search(marked, at + BLOCK)
                to = cut.start() if cut else to
            words = WORDS.findall(marked, at, to)
            if max(map(len, words)) > LONGEST_KEPT:
                words = [p for w in words for p in self.parts(w)]
            yield to - at, words
            at = to

    def encode_batch(self, batch: Iterable[str]) -> Iterator[tuple[int, bytes, bytes]]:
        """For each text what :data:`lodestone.llm.bpe.OUTPUTS` are made of: number of ids, ids, decoded text."""
        made: list[list] = []
        waiting: list[tuple[int, list[str]]] = []
        chars = 0

        def settle():
            self.learn([words for _, words in waiting])
            for k, words in waiting:
                made[k] += map(self.words.__getitem__, words)
            waiting.clear()
            self.forget()

        for text in batch:
            made.append([])
            for size, words in self.sections(text):
                waiting.append((len(made) - 1, words))
                chars += size
                if chars >= BLOCK:
                    settle()
                    chars = 0
        settle()
        edge = [np.array([i], "<u4").tobytes() for i in (self.begin, self.end)]
        for words in made:
            # The mark put before a text isn't shown.
            yield sum(map(FIRST, words)) + 2, b"".join([edge[0], *map(SECOND, words), edge[1]]), b"".join(map(THIRD, words))[1:]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(next(self.encode_batch([text]))[1], "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids: control pieces are not shown, bytes that make no character are shown as U+FFFD each."""
        out, raw, empty = [], bytearray(), True

        def flush():
            if raw:
                out.append("".join(_characters(bytes(raw))))
                raw.clear()

        for i in ids:
            if i in self.bytes:
                raw += self.bytes[i]
                empty = False
                continue
            flush()
            if i in self.control:
                continue
            name = " ⁇ " if i == self.unknown else self.names[i]
            if empty and i != self.unknown:
                name = name.removeprefix(SPACE)
            empty = False
            out.append(name.replace(SPACE, " "))
        flush()
        return "".join(out)


def _characters(raw: bytes) -> Iterator[str]:
    while raw:
        for size in range(1, 5):
            try:
                one = raw[:size].decode("utf-8")
            except UnicodeDecodeError:
                continue
            break
        else:
            size, one = 1, "�"
        yield one
        raw = raw[size:]


_LOADED: dict[str, PieceBPE] = {}


def tokenizer(path: str) -> PieceBPE:
    """The vocabulary at ``path``, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceBPE(path)
    return _LOADED[path]


def piece_frame(
    docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text, with begin and end ids, and decode the ids: the id column and the chosen ``outputs``.

    No shuffle: each Arrow batch is encoded where it lies, all its new words together. ``path`` is the vocabulary's file, which
    each worker reads by itself. What is kept of words is bounded and only saves time. A long text is encoded in sections
    that end where a word does; a long word is cut where no piece has the two characters side by side.

    Defined cases: a null text is the empty text, which has the begin and end ids only and decodes to the empty text; characters
    that no piece has become the ids of their bytes; ids may be null and rows may repeat; an empty table gives no rows; further
    columns are dropped.
    """
    kinds = [OUTPUTS[o] for o in outputs]

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in kinds]
        for made in tokenizer(path).encode_batch(texts(batch.column(1))):
            for column, (_, value) in zip(columns, kinds):
                column.append(value(*made))
        arrays = [pa.array(c, ARROW_TYPES[t]) for c, (t, _) in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names=["doc_id", *outputs])

    schema = ", ".join(["doc_id long", *(f"{o} {t}" for o, (t, _) in zip(outputs, kinds))])
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), encode, schema)
