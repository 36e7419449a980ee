"""A quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow import map_batches, texts

#: At most this many labelled rows are learnt from: those of the smallest hashes of their ids.
MAX_LABELLED = 20_000
THRESHOLD = 0.7

# Statistics of a text; order and names are the model's input columns.
BYTE_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "space": (9, 10, 11, 12, 13, 32),
    "stop": b".!?",
    "comma": b",;:",
    "quote": b"'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "high": range(128, 256),
    "control": [b for b in range(32) if not 9 <= b <= 13],
}
FEATURES = [
    *(f"share_{c}" for c in BYTE_CLASSES),
    "log_bytes",
    "log_words",
    "word_length",
    "word_length_spread",
    "longest_word",
    "distinct_words",
    "top_word",
    "top_five_words",
    "short_words",
    "symbol_words",
    "upper_words",
    "digit_words",
    "word_entropy",
    "lines",
    "distinct_lines",
    "line_length",
    "short_lines",
    "ended_lines",
    "top_line",
    "stops_per_word",
    "byte_entropy",
    "compressed",
    "repeated_pairs",
    "links",
]
_CLASS = np.zeros((256, len(BYTE_CLASSES)))
for _i, _members in enumerate(BYTE_CLASSES.values()):
    _CLASS[list(_members), _i] = 1


def statistics(text: str) -> list[float]:
    """The statistics of a whole text; all are finite, and an empty text has zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / len(raw)
    used = share[share > 0]
    words = raw.split()
    n = max(len(words), 1)
    seen = Counter(words)
    often = [c for _, c in seen.most_common(5)] or [0]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    times = np.fromiter(seen.values(), np.float64, len(seen)) / n if seen else np.ones(1)
    lines = [x for x in raw.split(b"\n") if x.strip()] or [b""]
    line_counts = Counter(lines)
    symbols = sum(c for w, c in seen.items() if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in (b".", b",", b"!", b"?", b";", b":", b"'", b'"', b")"))
    pairs = Counter(zip(words, words[1:]))
    return [
        *(share @ _CLASS).tolist(),
        math.log1p(len(raw)),
        math.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(float(lengths.max())),
        len(seen) / n,
        often[0] / n,
        sum(often) / n,
        float((lengths <= 2).sum()) / n,
        symbols / n,
        sum(c for w, c in seen.items() if w.isupper()) / n,
        sum(c for w, c in seen.items() if w[:1].isdigit()) / n,
        float(-(times * np.log2(times)).sum()),
        math.log1p(len(lines)),
        len(line_counts) / len(lines),
        math.log1p(len(raw) / len(lines)),
        sum(len(x) < 30 for x in lines) / len(lines),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
        line_counts.most_common(1)[0][1] / len(lines),
        float(counts[list(b".!?")].sum()) / n,
        float(-(used * np.log2(used)).sum()),
        len(zlib.compress(raw, 1)) / len(raw),
        sum(c - 1 for c in pairs.values()) / n,
        (raw.count(b"http") + raw.count(b"www.")) / n,
    ]


@dataclass
class Trees:
    """All trees in flat arrays: node i has feature, limit and two children; leaves point to themselves."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the rows: every row goes down every tree at the same time, one level a step."""
        if not len(x):
            return np.zeros(0)
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))[:, None]
        if len(self.roots):
            at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
            total = total + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Trees:
    """Boost trees on the logistic loss; splits are sought on histograms of binned features.

    Without rows the score is 1 (nothing speaks against a text); with one class only it is near that class.
    """
    feature, limit, left, right, value, roots = [], [], [], [], [], []
    share = float(y.mean()) if len(y) else 1.0
    prior = math.log(min(max(share, 1e-6), 1 - 1e-6) / (1 - min(max(share, 1e-6), 1 - 1e-6))) if len(y) else 40.0
    if len(y) and 0 < share < 1:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        offset = np.arange(x.shape[1]) * (bins + 1)
        width = x.shape[1] * (bins + 1)
        raw = np.full(len(y), prior)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            roots.append(len(feature))
            todo = [(np.arange(len(y)), depth, _node(feature, limit, left, right, value))]
            while todo:
                rows, levels, node = todo.pop()
                gs, hs = g[rows].sum(), h[rows].sum()
                best = None
                if levels:
                    flat = (binned[rows] + offset).ravel()
                    hg = np.bincount(flat, np.repeat(g[rows], x.shape[1]), width).reshape(x.shape[1], -1).cumsum(axis=1)
                    hh = np.bincount(flat, np.repeat(h[rows], x.shape[1]), width).reshape(x.shape[1], -1).cumsum(axis=1)
                    gain = hg**2 / (hh + l2) + (gs - hg) ** 2 / (hs - hh + l2) - gs**2 / (hs + l2)
                    gain[(hh < least / 4) | (hs - hh < least / 4)] = -1
                    j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[j, b] > 1e-6 and b < len(cuts[j]):
                        best = int(j), int(b)
                if best is None:
                    value[node] = -rate * gs / (hs + l2)
                    raw[rows] += value[node]
                    continue
                j, b = best
                feature[node], limit[node] = j, float(cuts[j][b])
                low = binned[rows, j] <= b
                for side, part in ((left, rows[low]), (right, rows[~low])):
                    side[node] = _node(feature, limit, left, right, value)
                    todo.append((part, levels - 1, side[node]))
    return Trees(np.array(feature, np.int64), np.array(limit), np.array(left, np.int64), np.array(right, np.int64), np.array(value), np.array(roots, np.int64), depth, prior)


def _node(feature, limit, left, right, value) -> int:
    i = len(feature)
    for column, x in ((feature, 0), (limit, 0.0), (left, i), (right, i), (value, 0.0)):
        column.append(x)
    return i


def held_out(id_col: str = "doc_id"):
    """The fold that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MAX_LABELLED) -> Trees:
    """Learn from at most ``most`` labelled documents outside the held-out fold, chosen by the hash of their ids.

    The sample's ids are bounded by ``most``, so they are broadcast; only its statistics come to the driver, a row an id.
    An id with contradictory labels counts as 0; of rows that share an id the one of the least statistics counts; ids and labels
    that are null are left out.
    """
    own = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna()
    chosen = own.filter(~held_out("_id")).groupBy("_id").agg(F.min("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    sample = source.join(F.broadcast(chosen), "_id").select("_id", "_y", "text")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pa.array([statistics(t) for t in texts(batch.column(2))], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), x], names=["_id", "_y", "x"])

    measured = map_batches(sample, measure, "_id long, _y int, x array<double>")
    rows = measured.groupBy("_id").agg(F.min("_y").alias("_y"), F.min("x").alias("x")).toPandas().sort_values("_id")
    x = np.array(rows.x.tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, (rows._y.to_numpy() > 0).astype(float))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text; no shuffle.

    Defined cases: null text is the empty text and is scored like any other; a null id is not held out; rows may
    repeat; an empty table gives no rows; further columns are dropped.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in texts(batch.column(1))], float).reshape(batch.num_rows, len(FEATURES))
        p = np.round(np.concatenate([trees.scores(x[i : i + 1024]) for i in range(0, len(x), 1024)]), 12)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out(id_col).alias("held_out"))
    return map_batches(source, run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, that the classifier does not reject; decided row by row without a join."""
    columns, place = docs.columns, docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in texts(batch.column(place))], float).reshape(batch.num_rows, len(FEATURES))
        p = np.concatenate([trees.scores(x[i : i + 1024]) for i in range(0, len(x), 1024)])
        return batch.filter(pa.array(np.round(p, 12) >= THRESHOLD))

    return map_batches(docs.select(*columns), run, docs.schema)
