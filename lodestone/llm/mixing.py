"""Mixing sources to target weights: soft domain membership and nonnegative document rates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import discard, stage
from lodestone.llm.arrow import map_batches, texts

#: At most this many labelled documents are learnt from: those of the smallest hashes of their ids.
MAX_LABELLED = 20_000
#: Hashed byte triples, and for how many of them at most a text's evidence counts.
BUCKETS, EVIDENCE = 1 << 13, 60
MOST_STEPS, TOLERANCE = 60, 1e-9
#: Target shares of the domains' tokens.
WEIGHTS = {"de": 0.2, "en": 0.5, "es": 0.15, "fr": 0.15}

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def triple_counts(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.uint32)
    if len(x) < 3:
        return np.zeros(BUCKETS, np.int64)
    mixed = ((x[:-2] << 16) | (x[1:-1] << 8) | x[2:]) * np.uint32(2654435761)
    return np.bincount(mixed >> np.uint32(19), minlength=BUCKETS)


def measure(text: str) -> tuple[int, np.ndarray]:
    """Number of words and counts of hashed byte triples of a whole text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return 0, np.zeros(BUCKETS, np.int64)
    inside = ~_SPACE[raw]
    return int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum()), triple_counts(raw)


@dataclass
class Mixture:
    """Domains in order, each one's log shares of triples and log prior, and the steps of the rates' descent."""

    domains: list[str]
    shares: np.ndarray
    prior: np.ndarray
    steps: list[np.ndarray] = field(default_factory=list)
    totals: np.ndarray | None = None
    targets: np.ndarray | None = None
    #: The largest difference between a domain's expected tokens and its target, as a share of all target tokens.
    gap: float = 0.0

    def posterior(self, counts: np.ndarray) -> np.ndarray:
        """Soft membership of a text; without triples it is the prior. More than EVIDENCE triples weigh no more."""
        n = counts.sum()
        evidence = self.shares @ counts * (min(n, EVIDENCE) / n) if n else 0
        z = self.prior + evidence
        p = np.exp(z - z.max())
        return np.round(p / p.sum(), 9)

    def memberships(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words and posteriors of the texts; one text's counts are held at a time."""
        tokens, p = np.zeros(len(batch), np.int64), np.zeros((len(batch), len(self.domains)))
        for i, text in enumerate(batch):
            tokens[i], counts = measure(text)
            p[i] = self.posterior(counts)
        return tokens, p

    def rates(self, p: np.ndarray) -> np.ndarray:
        """The rates of documents with posteriors ``p`` (rows): every step goes down and back to nonnegative."""
        r = np.ones(len(p))
        for step in self.steps:
            r = np.maximum(0.0, r - p @ step)
        return r


def learn_domains(docs: DataFrame, labelled: DataFrame, domain_col: str, domains: list[str], id_col="doc_id", text_col="text", most=MAX_LABELLED) -> Mixture:
    """A naive Bayes classifier of texts by the domain of labelled documents.

    ``labelled`` names the documents (id) whose ``domain_col`` is to be trusted; a bounded sample of their ids is
    broadcast. Sums per domain and bucket, a fixed number, come to the driver.
    """
    ids = labelled.select(F.col(id_col).cast("long").alias("_id")).dropna().distinct().orderBy(F.xxhash64("_id"), "_id").limit(most)
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(domain_col).cast("string").alias("domain"), F.col(text_col).cast("string").alias("text"))
    sample = source.filter(F.col("domain").isin(domains)).join(F.broadcast(ids), "_id", "left_semi").select("domain", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(domains), BUCKETS + 1), np.int64)
        for batch in batches:
            for domain, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                row = sums[domains.index(domain)]
                row[:-1] += measure(text)[1]
                row[-1] += 1
        at, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bucket), pa.array(sums[at, bucket])], names=["at", "bucket", "n"])

    sums = np.zeros((len(domains), BUCKETS + 1))
    for at, bucket, n in sample.mapInArrow(count, "at long, bucket long, n long").groupBy("at", "bucket").agg(F.sum("n")).collect():
        sums[at, bucket] = n
    counts, seen = sums[:, :-1] + 0.5, sums[:, -1] + 1
    return Mixture(domains, np.log(counts / counts.sum(axis=1, keepdims=True)), np.log(seen / seen.sum()))


def members(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tokens, p): words and posteriors of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, p = mixture.memberships(texts(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens), pa.array(list(p), pa.list_(pa.float64()))], names=["doc_id", "tokens", "p"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, tokens long, p array<double>")


def _sums(table: DataFrame, mixture: Mixture) -> np.ndarray:
    """Over all documents, the sums of tokens * p * rate and of tokens * p * p'; one row of partial sums a task."""
    k = len(mixture.domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                t = batch.column(0).to_numpy().astype(float)
                p = batch.column(1).flatten().to_numpy().reshape(-1, k)
                total[:k] += (t * mixture.rates(p)) @ p
                total[k:] += ((p * t[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in total], names=[f"s{i}" for i in range(len(total))])

    parts = table.select("tokens", "p").mapInArrow(run, ", ".join(f"s{i} double" for i in range(k + k * k)))
    return np.array([x or 0.0 for x in parts.agg(*(F.sum(c) for c in parts.columns)).first()])


def fit_rates(table: DataFrame, mixture: Mixture, weights: dict[str, float], budget: float | None = None) -> Mixture:
    """Projected-gradient least squares for the documents' rates, from rate 1 for all.

    The rates r >= 0 shall make the expected tokens of each domain, A r with a column tokens * p a document, meet
    ``budget * weights``. Steps minimise the residual in the norm of G^-1, G = sum of tokens * p * p', over rates
    scaled by the square root of tokens; there the step 1 is safe, and a document's rate depends on its posterior
    only. Each step is one pass over the narrow table and sends one vector of domains to the driver. Steps end when targets are
    met to TOLERANCE, when a step brings nothing, or after MOST_STEPS; what is missing then is the mixture's ``gap``, as where
    no document belongs to a domain. Without a budget it is the least with which no domain has to shrink, so documents are
    repeated and not lost.
    """
    k = len(mixture.domains)
    w = np.array([weights[d] for d in mixture.domains], float)
    w = w / w.sum()
    sums = _sums(table, mixture)
    mixture.totals = sums[:k]
    budget = float(np.max(mixture.totals / np.maximum(w, 1e-12))) if budget is None else budget
    mixture.targets = budget * w
    inverse = np.linalg.pinv(sums[k:].reshape(k, k)) if budget else np.zeros((k, k))
    got = mixture.totals
    for _ in range(MOST_STEPS if budget else 0):
        if np.abs(got - mixture.targets).max() <= TOLERANCE * budget:
            break
        mixture.steps.append(inverse @ (got - mixture.targets))
        got = _sums(table, mixture)[:k]
    mixture.gap = float(np.abs(got - mixture.targets).max() / budget) if budget else 0.0
    return mixture


def fit(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, domain_col: str = "lang", id_col="doc_id", text_col="text") -> Mixture:
    """Learn the domains from labelled documents, then fit the rates over all documents."""
    weights = weights or WEIGHTS
    mixture = learn_domains(docs, labelled, domain_col, sorted(weights), id_col, text_col)
    table = stage(members(docs, mixture, id_col, text_col), "members")
    mixture = fit_rates(table, mixture, weights)
    discard(table)
    return mixture


def _copies(ids: list, read: list[str], rates: np.ndarray) -> list[int]:
    """Whole copies, and one more with the probability that is left, drawn from the id's hash, or the text's where there is no id."""
    from xxhash import xxh64_intdigest

    drawn = [t.encode("utf-8", "surrogatepass") if i is None else str(i).encode() for i, t in zip(ids, read)]
    draw = np.array([xxh64_intdigest(x, 7) / 2**64 for x in drawn])
    whole = np.floor(rates)
    return (whole + (draw < rates - whole)).astype(np.int64).tolist()


def document_rates(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, tokens, one column p_<domain> each, rate, copies and the mixture's target_gap.

    The model is a few arrays, so rates are worked out where the documents lie, without a shuffle.

    Defined cases: null and empty texts have 0 tokens, the prior as posterior and a rate like any other; rows may
    repeat; rows without id draw by their text; without labelled documents all domains are equally likely; an empty
    table gives no rows; further columns are dropped.
    """
    names = [f"p_{d}" for d in mixture.domains]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        read = texts(batch.column(1))
        tokens, p = mixture.memberships(read)
        rate = np.round(mixture.rates(p), 6)
        columns = [batch.column(0), pa.array(tokens), *(pa.array(p[:, i]) for i in range(p.shape[1])), pa.array(rate)]
        columns += [pa.array(_copies(batch.column(0).to_pylist(), read, rate), pa.int64()), pa.array(np.full(len(rate), mixture.gap))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "tokens", *names, "rate", "copies", "target_gap"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(source, run, ", ".join(["doc_id long", "tokens long", *(f"`{n}` double" for n in names), "rate double", "copies long", "target_gap double"]))


def mix(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, each as often as its copies say; cases as for :func:`document_rates`."""
    text_at, id_at = docs.columns.index(text_col), docs.columns.index(id_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        read = texts(batch.column(text_at))
        _, p = mixture.memberships(read)
        copies = _copies(batch.column(id_at).to_pylist(), read, np.round(mixture.rates(p), 6))
        return batch.take(pa.array(np.repeat(np.arange(batch.num_rows), copies)))

    return map_batches(docs.select(*docs.columns), run, docs.schema)
