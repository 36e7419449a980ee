"""Boosted regression trees that grow leaf by leaf, from histograms that Spark sums over all rows."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lodestone.catalog import discard, shared_dir, stage

#: Blocks of cells: bins, numbers of rows and sums of labels as arrays, and sums over the block.
BLOCK = ["x binary", "n binary", "y binary", "cells long", "fit long", "fit_n long", "all_n long", "fit_y long", "all_y long", "spread double"]
#: Bins of a feature's values; one more is for missing ones.
BINS = 255
#: Partitions whose sums the driver adds up itself; sums of more are added up by tasks first.
FEW_PARTS = 64
#: Tables of at most so many cells (see :func:`_cells`) are grown by one task a forest: there is nothing to sum up between tasks.
ONE_TASK = 1 << 21
#: Cells of a block, rows that are worked on at a time, and rounds after which the chain of residuals is cut by a checkpoint.
ROWS, CHUNK, CUT_AFTER = 1 << 16, 1 << 15, 25


@dataclass
class Node:
    """A node: what its rows sum up to, its best split, and its children once there are any."""

    total: float
    rows: int
    histogram: np.ndarray | None = None
    split: tuple | None = None  # gain, feature, bin, missing values go left, left total, left rows
    children: tuple[int, int] | None = None


@dataclass
class Tree:
    """A tree that grows: of its nodes those on the way to ``leaves`` leaves count, best gains first."""

    leaves: int
    nodes: list[Node] = field(default_factory=list)

    def expand(self) -> tuple[list[int], list[int]]:
        """(splits in order, nodes among them whose children's histograms are still to be made).

        The nodes of the best gains are split until there are enough leaves. A node whose children are unknown takes its place in the order,
        and those behind it are looked at as well: they may be wanted, so one pass over the rows serves them all.
        """
        order, unknown = [], []
        heap = [(-self.nodes[0].split[0], 0)] if self.nodes[0].split else []
        while heap and len(order) + 1 < self.leaves:
            _, k = heapq.heappop(heap)
            order.append(k)
            node = self.nodes[k]
            if node.children is None:
                _, _, _, _, total, rows = node.split
                node.children = (len(self.nodes), len(self.nodes) + 1)
                self.nodes += [Node(total, rows), Node(node.total - total, node.rows - rows)]
            if len(order) + 1 < self.leaves:
                if self.nodes[node.children[0]].histogram is None:
                    unknown.append(k)
                for c in node.children:
                    if self.nodes[c].split:
                        heapq.heappush(heap, (-self.nodes[c].split[0], c))
        return order, unknown

    def arrays(self, splits: Sequence[int]) -> np.ndarray:
        """Rows (feature, bin, missing left, left, right, value) of all nodes; nodes that aren't among the splits are leaves."""
        out = np.zeros((len(self.nodes), 6))
        out[:, 0] = -1
        for k in splits:
            _, feature, at, missing, _, _ = self.nodes[k].split
            out[k, :5] = feature, at, missing, *self.nodes[k].children
        return out

    def finished(self, value) -> np.ndarray:
        """As :meth:`arrays` of the final splits, with the leaves' values and without the nodes that were looked at in vain."""
        splits, _ = self.expand()
        used = [0, *(c for k in splits for c in self.nodes[k].children)]
        out = self.arrays(splits)[used]
        place = {k: i for i, k in enumerate(used)}
        inner = out[:, 0] >= 0
        out[inner, 3:5] = [[place[int(c)] for c in pair] for pair in out[inner, 3:5]] or np.zeros((0, 2))
        out[:, 5] = [value(self.nodes[k].total, self.nodes[k].rows) for k in used]
        return out


def leaves_of(tree: np.ndarray) -> list[int]:
    """The leaves of a tree (see :meth:`Tree.arrays`), from left to right."""
    out, stack = [], [0]
    while stack:
        k = stack.pop()
        if tree[k, 0] < 0:
            out.append(k)
        else:
            stack += [int(tree[k, 4]), int(tree[k, 3])]
    return out


def masks(tree: np.ndarray, leaves: Sequence[int]) -> dict[int, np.ndarray]:
    """For each feature that the tree asks, and each bin, a bit for each leaf: whether that feature's nodes leave it within reach."""
    kind = np.uint32 if len(leaves) <= 32 else np.uint64
    place, out, all_ = {k: i for i, k in enumerate(leaves)}, {}, np.iinfo(kind).max

    def under(k: int) -> int:
        if tree[k, 0] < 0:
            return 1 << place[k]
        feature, at, missing, left, right = (int(x) for x in tree[k, :5])
        on_left = under(left)
        bins = out.setdefault(feature, np.full(BINS + 1, all_, kind))
        bins[at + 1 : BINS if missing else BINS + 1] &= kind(all_ ^ on_left)
        return on_left | under(right)

    under(0)
    return out


def ready(tree: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]] | None:
    """The leaves and :func:`masks` of a tree, to be used for many blocks; None for trees of more than 64 leaves."""
    ends = leaves_of(tree)
    return (np.array(ends), masks(tree, ends)) if len(ends) <= 64 else None


def walked(tree: np.ndarray, binned: np.ndarray, made: tuple | None = None) -> np.ndarray:
    """The node of the tree (see :meth:`Tree.arrays`) at which each row ends.

    A row that goes right at a node loses the leaves on its left, whether it gets there or not, and ends at the first leaf that all of its features
    leave: a look at a table for each feature, whatever the depth. Trees of more than 64 leaves are walked node by node.
    ``made`` is what :func:`ready` gives, if it is known.
    """
    made = made or ready(tree)
    if made is None:
        return _by_steps(tree, binned)
    (nodes, tables), out = made, np.zeros(len(binned), np.int64)
    for at in range(0, len(binned) if tables else 0, CHUNK):
        part = binned[at : at + CHUNK]
        reach = None
        for feature, table in tables.items():
            left = table[part[:, feature]]
            reach = left if reach is None else np.bitwise_and(reach, left, out=reach)
        reach &= ~reach + reach.dtype.type(1)  # a power of two, whose exponent as a float is the leaf's place
        bits = reach.astype(np.float32).view(np.int32) >> 23
        out[at : at + CHUNK] = nodes[bits - 127]
    return out


def _by_steps(tree: np.ndarray, binned: np.ndarray) -> np.ndarray:
    feature, at, missing, left, right = (tree[:, k].astype(np.int64) for k in range(5))
    node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
    open_ = rows if feature[0] >= 0 else rows[:0]
    while len(open_):
        here = node[open_]
        value = binned[open_, feature[here]]
        to_left = np.where(value == BINS, missing[here] == 1, value <= at[here])
        node[open_] = here = np.where(to_left, left[here], right[here])
        open_ = open_[feature[here] >= 0]
    return node


def best_split(node: Node, ridge: float, least: int) -> tuple | None:
    """The split of the largest gain, the first feature and bin among equal ones; None if none gains anything.

    ``node.histogram`` has a feature's (sum of residuals, rows) in each bin. Missing values go to either side, right if that is as good.
    """
    if node.rows < 2 * least:
        return None
    sums, rows = node.histogram[..., 0], node.histogram[..., 1]
    cost = lambda g, n: g * g / (n + ridge)
    best = None
    for missing in (0, 1):
        g, n = np.cumsum(sums[:, :BINS], axis=1), np.cumsum(rows[:, :BINS], axis=1)
        if missing:
            g, n = g + sums[:, BINS:], n + rows[:, BINS:]
        gain = cost(g, n) + cost(node.total - g, node.rows - n) - cost(node.total, node.rows)
        gain[(n < least) | (node.rows - n < least)] = -np.inf
        if missing:
            gain[rows[:, BINS] == 0] = -np.inf
        feature, at = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[feature, at] > (best[0] if best else 1e-9 * (1 + cost(node.total, node.rows))):
            best = (float(gain[feature, at]), int(feature), int(at), missing, float(g[feature, at]), int(n[feature, at]))
    return best


def histograms(binned: np.ndarray, residual: np.ndarray, node: np.ndarray, wanted: Sequence[int], times: np.ndarray | None = None) -> np.ndarray:
    """For each wanted node and feature the (sum of residuals, rows) in each bin. ``times``: the rows that each one stands for, if not one."""
    place = np.full(max(node.max(initial=0), max(wanted)) + 1, -1)
    place[list(wanted)] = np.arange(len(wanted)) * (BINS + 1)
    size, out = len(wanted) * (BINS + 1), np.zeros((binned.shape[1], 2, len(wanted) * (BINS + 1)))
    for at in range(0, len(node), CHUNK):
        base, part, r = place[node[at : at + CHUNK]], binned[at : at + CHUNK], residual[at : at + CHUNK]
        rows = np.flatnonzero(base >= 0)
        some = len(rows) < len(base)
        base, r = (base[rows], r[rows]) if some else (base, r)
        n = None if times is None else times[at : at + CHUNK].astype(float)
        n = n[rows] if some and n is not None else n
        for f in range(binned.shape[1]):
            key = base + (part[:, f][rows] if some else part[:, f])
            out[f, 0] += np.bincount(key, r, size)
            out[f, 1] += np.bincount(key, n, size)
    return np.ascontiguousarray(out.reshape(binned.shape[1], 2, len(wanted), BINS + 1).transpose(2, 0, 3, 1))


class Forest:
    """Boosted trees over features cut into bins: the prediction is ``base`` and the sum of the trees' values."""

    def __init__(self, features: Sequence[str], edges: list[np.ndarray], base: float, trees: list[np.ndarray], leaves: int):
        self.features, self.edges, self.base, self.trees, self.leaves = list(features), edges, base, trees, leaves

    def predict(self, binned: np.ndarray, made: Sequence[tuple | None] | None = None) -> np.ndarray:
        out = np.full(len(binned), self.base)
        for tree, known in zip(self.trees, made or [None] * len(self.trees)):
            out += tree[walked(tree, binned, known), 5]
        return out

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """The rows with a column of predictions; missing features are a bin of their own. Rows stay where they are."""
        own, inputs = self, [F.col(f).cast("double").alias(f"_lodestone_{k}") for k, f in enumerate(self.features)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = [ready(tree) for tree in own.trees]
            for batch in batches:
                made = own.predict(cut([batch.column(k) for k in range(len(own.features))], own.edges), known)
                yield pa.RecordBatch.from_arrays([*batch.columns[len(own.features) :], pa.array(made)], names=[*batch.schema.names[len(own.features) :], name])

        kept = [c for c in df.columns if c != name]
        schema = df.select(kept).schema.add(name, "double")
        return df.select(*inputs, *kept).mapInArrow(run, schema)


def cut(columns: Sequence[pa.Array], edges: Sequence[np.ndarray]) -> np.ndarray:
    """The values' bins, a column each: how many edges are below the value; null and NaN have bin 255."""
    out = np.empty((len(columns[0]), len(columns)), np.uint8)
    for k, (column, e) in enumerate(zip(columns, edges)):
        values = column.to_numpy(zero_copy_only=False).astype(float)
        out[:, k] = np.where(np.isnan(values), BINS, np.searchsorted(e, values, side="left"))
    return out


def _in_order(values: np.ndarray) -> np.ndarray:
    """Doubles as integers of the same order, and such integers' bits as those of the doubles."""
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def _counted(df: DataFrame, columns: Sequence[str], shift: int, within: list[np.ndarray] | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each column its finite values' leading bits, all but ``shift`` of 64, and how often each occurs; only ``within`` leading bits of 8 fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[] for _ in columns]

        def summed(k: int) -> tuple[np.ndarray, np.ndarray]:
            parts, place = np.unique(np.concatenate([p for p, _ in got[k]]), return_inverse=True)
            return parts, np.bincount(place, np.concatenate([n for _, n in got[k]]), len(parts)).astype(np.int64)

        for batch in batches:
            for k in range(len(columns)):
                values = batch.column(k).to_numpy(zero_copy_only=False).astype(float)
                parts = _in_order(values[np.isfinite(values)] + 0.0) >> shift
                if within is not None:
                    at = np.searchsorted(within[k][1:], parts >> 8, side="right")
                    parts = parts[within[k][at] == parts >> 8] if len(within[k]) else parts[:0]
                got[k].append(np.unique(parts, return_counts=True))
                if sum(len(p) for p, _ in got[k]) > 1 << 18:
                    got[k] = [summed(k)]
        for k in range(len(columns)):
            if got[k]:
                parts, n = summed(k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), k, np.int32)), pa.array(parts), pa.array(n)], names=["feature", "part", "n"])

    found = df.select(*columns).mapInArrow(run, "feature int, part long, n long").groupBy("feature", "part").agg(F.sum("n").alias("n")).toArrow()
    feature, part, n = (found.column(k).to_numpy() for k in range(3))
    order = np.lexsort((part, feature))
    feature, part, n = feature[order], part[order], n[order]
    return [(part[feature == k], n[feature == k]) for k in range(len(columns))]


def bin_edges(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """The inner borders of up to 255 bins of each feature, at its exact quantiles by linear interpolation.

    Values aren't moved: passes count them by their leading 16, 24, ... 64 bits, from the second pass on only where a wanted rank lies. The
    driver gets at most 256 counts for each of a feature's 508 ranks at a time.
    """
    points = np.array([i / BINS for i in range(1, BINS)])
    columns = [F.col(f).cast("double").alias(f"_lodestone_{k}") for k, f in enumerate(features)]
    df, names = df.select(*columns), [f"_lodestone_{k}" for k in range(len(features))]
    found, ranks, left, within = [], [], [], None
    for shift in range(48, -1, -8):
        counts = _counted(df, names, shift, within)
        if within is None:
            ranks = [(n.sum() - 1) * points if len(n) else points[:0] for _, n in counts]
            left = [np.concatenate([np.floor(r), np.ceil(r)]).astype(np.int64) for r in ranks]
            found = [np.zeros(len(x), np.int64) for x in left]
        for k, (parts, n) in enumerate(counts):
            if len(parts):
                upto = np.cumsum(n)
                if within is not None:
                    left[k] = left[k] + (upto - n)[np.searchsorted(parts >> 8, found[k])]
                at = np.searchsorted(upto, left[k], side="right")
                found[k], left[k] = parts[at], left[k] - (upto - n)[at]
        within = [np.unique(f) for f in found]
    out = []
    for rank, bits in zip(ranks, found):
        low, high = np.split(_in_order(bits).view(float), 2)
        out.append(np.unique(np.where(np.floor(rank) == np.ceil(rank), low, (np.ceil(rank) - rank) * low + (rank - np.floor(rank)) * high)))
    return out


def _cells(rows: DataFrame, edges: list[np.ndarray], low: float, scale: float) -> DataFrame:
    """(x, held, n, y, spread): rows of equal bins that are all held out or all not, as one cell with their number and the sum of their labels.

    Trees can't tell such rows apart, and their residuals' sum is the labels' sum less n predictions. y is in steps of 1/scale above ``low``, so that
    sums are exact; spread is the sum of squares around the cell's mean, which no tree changes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = cut(batch.columns[: len(edges)], edges)
            labels = batch.column(len(edges)).to_numpy(zero_copy_only=False).astype(float) - low
            starts = np.arange(len(bins) + 1, dtype=np.int32) * len(edges)
            x = pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(starts), pa.py_buffer(bins.tobytes())])
            columns = [x, batch.column(len(edges) + 1), pa.array(np.rint(labels * scale).astype(np.int64)), pa.array(labels)]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "held", "y", "label"])

    made = rows.mapInArrow(run, "x binary, held boolean, y long, label double")
    n = F.count(F.lit(1))
    return made.groupBy("x", "held").agg(n.alias("n"), F.sum("y").alias("y"), (n * F.var_pop("label")).alias("spread"))


def _blocks(cells: DataFrame, width: int) -> DataFrame:
    """Blocks of some 2^16 cells, those that aren't held out first, a column's bins together; and what their cells sum up to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Cells of one row and of more are in blocks of their own: those of one row need no numbers of rows.
        pending, sizes = ([], []), [0, 0]

        def settle(got):
            bins, held, n, y, spread = (np.concatenate([g[k] for g in got]) for k in range(5))
            order = np.argsort(held, kind="stable")
            sums = [len(held), int((~held).sum()), int(n[~held].sum()), int(n.sum()), int(y[~held].sum()), int(y.sum()), float(spread[held].sum())]
            packed = [bins[order].tobytes("F"), n[order].tobytes(), y[order].astype(float).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in packed + sums], names=[c.split()[0] for c in BLOCK])

        for batch in batches:
            x = batch.column(0)
            starts = np.frombuffer(x.buffers()[1], np.int32)[x.offset :]
            bins = np.frombuffer(x.buffers()[2], np.uint8)[starts[0] : starts[0] + len(x) * width].reshape(-1, width)
            columns = [bins, *(batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 5))]
            for kind, here in enumerate((columns[2] == 1, columns[2] > 1)):
                pending[kind].append([c[here] for c in columns])
                sizes[kind] += int(here.sum())
                if sizes[kind] >= ROWS:
                    yield settle(pending[kind])
                    pending[kind].clear()
                    sizes[kind] = 0
        for kind in range(2):
            if sizes[kind]:
                yield settle(pending[kind])

    return cells.mapInArrow(run, ", ".join(BLOCK))


def _merged(blocks: Iterable[tuple]) -> Iterator[tuple]:
    """The cells of small blocks in blocks of some 2^16; those with numbers of rows stay by themselves. Many small tasks leave many small blocks."""
    pending, sizes = {3: [], 4: []}, {3: 0, 4: 0}

    def settle(got: list[tuple]) -> tuple:
        if len(got) == 1:
            return got[0]
        bins, residuals, *n = ([(b[k], b[1]) for b in got] for k in range(len(got[0])) if k != 1)
        halves = lambda arrays: [a[..., :fit] for a, fit in arrays] + [a[..., fit:] for a, fit in arrays]
        bins = np.concatenate(halves([(x.T, fit) for x, fit in bins]), axis=1).T
        return bins, sum(b[1] for b in got), np.concatenate(halves(residuals), axis=1), *(np.concatenate(halves(a)) for a in n)

    for b in blocks:
        pending[len(b)].append(b)
        sizes[len(b)] += len(b[0])
        if sizes[len(b)] >= ROWS:
            yield settle(pending[len(b)])
            pending[len(b)], sizes[len(b)] = [], 0
    yield from (settle(got) for got in pending.values() if got)


def _grow(df: DataFrame, features: Sequence[str], label: str, held: Column, models: list[tuple[int, bool]], trees: int, rate: float, ridge: float, least: int) -> tuple[list[Forest], list[float]]:
    """A forest for each (leaves, whether it learns from held-out rows too), and each one's RMSE on the held-out rows."""
    spark = df.sparkSession
    inputs = [F.col(f).cast("double").alias(f"_lodestone_{k}") for k, f in enumerate(features)]
    rows = stage(df.select(*inputs, F.col(label).cast("double").alias("_lodestone_y"), F.coalesce(held, F.lit(False)).alias("_lodestone_held")), "boosted")
    y, out = F.col("_lodestone_y"), F.col("_lodestone_held")
    about = rows.agg(F.count(F.when(~out, y)).alias("fit"), F.count(y).alias("all"), F.min(y).alias("low"), F.max(y).alias("high"), F.count_if(y.isNull() | F.isnan(y)).alias("bad")).first()
    if about.bad or any(not about["all" if whole else "fit"] for _, whole in models):
        raise ValueError(f"{about.bad} of {about['all'] + about.bad} rows have no label, {about.fit} may be learned from")
    edges = bin_edges(rows, rows.columns[: len(features)])
    scale = 2.0 ** np.floor(51 - np.log2(about["all"] * ((about.high - about.low) or 1.0)))
    value = lambda total, rows: rate * total / scale / (rows + ridge)
    blocks = stage(_blocks(_cells(rows, edges, about.low, scale), len(features)), "blocks")
    discard(rows)
    sums = blocks.agg(F.count(F.lit(1)).alias("blocks"), *(F.sum(c).alias(c) for c in blocks.columns[3:])).first()
    means = [sums["all_y" if whole else "fit_y"] / (scale * sums["all_n" if whole else "fit_n"]) for _, whole in models]
    bases = [about.low + m for m in means]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
    parts = max(1, min(sums.blocks, spark.sparkContext.defaultParallelism))

    def opened(r) -> tuple:
        n, y = np.frombuffer(r.n, np.int64), np.frombuffer(r.y) / scale
        residuals = np.stack([y - n * m for m in means])
        return (np.frombuffer(r.x, np.uint8).reshape(len(edges), -1).T, r.fit, residuals, *([n.astype(np.min_scalar_type(n.max()))] if n.max() > 1 else []))

    # Blocks: bins, how many cells to learn from, each forest's residuals, and the cells' numbers of rows unless all are one.
    state = blocks.select("x", "n", "y", "fit").repartition(parts).rdd.map(opened).mapPartitions(_merged).persist(StorageLevel.MEMORY_AND_DISK)
    wholes, before, forests = [whole for _, whole in models], None, [[] for _ in models]
    if sums.cells <= ONE_TASK:
        own = state.flatMap(lambda b: [(m, (b[0], b[1], r[None], *b[3:])) for m, r in enumerate(b[2])]).groupByKey(len(models))
        grown = dict(own.map(lambda x: (x[0], _alone(list(x[1]), models[x[0]], trees, scale, value, ridge, least))).collect())
        forests, squares = [grown[m][0] for m in range(len(models))], [grown[m][1] for m in range(len(models))]
    else:
        for turn in range(trees):

            def summed(plans, state=state):
                nonlocal before
                made = state.map(lambda b: _sums(b, plans, wholes, scale))
                found = made.reduce(_added) if made.getNumPartitions() <= FEW_PARTS else made.treeReduce(_added)
                if before is not None:
                    before.unpersist()
                    before = None
                return found

            made = _trees([k for k, _ in models], summed, value, ridge, least)
            for forest, tree in zip(forests, made):
                forest.append(tree)
            before, state = state, state.map(lambda b, made=made: _left(b, made)).persist(StorageLevel.MEMORY_AND_DISK)
            if turn % CUT_AFTER == CUT_AFTER - 1:
                state.checkpoint()
        squares = state.map(_held_out).reduce(lambda a, b: a + b)
    state.unpersist()
    discard(blocks)
    judged = about["all"] - about.fit
    errors = [float(np.sqrt((x + sums.spread) / judged)) if judged else float("nan") for x in squares]
    return [Forest(features, edges, base, f, k) for base, f, (k, _) in zip(bases, forests, models)], errors


def _trees(leaves: Sequence[int], summed, value, ridge: float, least: int) -> list[np.ndarray]:
    """The next tree of each forest. ``summed`` gets each forest's plan, the tree so far and the nodes wanted, and gives their histograms."""
    grown, plans = [Tree(k) for k in leaves], [(None, [0])] * len(leaves)
    while any(wanted for _, wanted in plans):
        found = summed(plans)
        for k, (tree, (_, wanted)) in enumerate(zip(grown, plans)):
            _learn(tree, wanted, found[k], ridge, least)
        plans = []
        for tree in grown:
            order, unknown = tree.expand()
            plans.append((tree.arrays(order), [min(tree.nodes[k].children, key=lambda c: tree.nodes[c].rows) for k in unknown]))
    return [tree.finished(value) for tree in grown]


def _left(block: tuple, trees: list[np.ndarray]) -> tuple:
    """The block with what the trees leave of its residuals."""
    values = [t[walked(t, block[0]), 5] for t in trees]
    return block[0], block[1], np.stack([r - v * block[3] if len(block) > 3 else r - v for r, v in zip(block[2], values)]), *block[3:]


def _held_out(block: tuple) -> np.ndarray:
    """Each forest's sum of squares of the held-out cells' mean residuals, times their rows."""
    squares = block[2][:, block[1] :] ** 2
    return (squares / block[3][block[1] :] if len(block) > 3 else squares).sum(axis=1)


def _alone(blocks: list[tuple], model: tuple[int, bool], trees: int, scale: float, value, ridge: float, least: int) -> tuple[list[np.ndarray], float]:
    """A forest, and its sum of squares on held-out rows, grown by one task from the few blocks that there are: the same trees without the waits."""
    forest, whole, blocks = [], [model[1]], list(_merged(blocks))
    for _ in range(trees):

        def summed(plans, blocks=blocks):
            found = [_sums(b, plans, whole, scale) for b in blocks]
            return reduce(_added, found)

        forest += _trees([model[0]], summed, value, ridge, least)
        blocks = [_left(b, forest[-1:]) for b in blocks]
    return forest, float(sum(_held_out(b)[0] for b in blocks))


def boost(
    df: DataFrame, features: Sequence[str], label: str, leaves: Sequence[int] = (7, 15, 31), trees: int = 200, rate: float = 0.05, ridge: float = 1.0, least: int = 20
) -> list[Forest]:
    """A forest for each number of leaves, of so many trees each, fitted to all rows by least squares.

    The features are cut into bins once, rows of equal bins become one cell (see :func:`_cells`), and blocks of bins and residuals stay with the
    executors. A pass sums, for all forests at
    once, the histograms of the nodes that are to be split next, map-side and then in a tree of tasks: what the driver gets has a number for each
    node, feature and bin. The best gain is split first; of each two children the one of fewer rows is summed up and the other is what is left of the
    parent. A tree takes as many passes as it is deep. Each tree's residuals are a new set of blocks, whose chain is cut by checkpoints.

    Residuals are rounded to multiples of a power of two such that sums are exact: the trees don't depend on how rows are dealt. A
    table of at most ONE_TASK cells has the same trees from one task for each forest, which saves a job for each pass.

    Defined cases: null and NaN features have a bin of their own; null and NaN labels raise, and so does a table without rows.
    """
    return _grow(df, features, label, F.lit(False), [(k, True) for k in leaves], trees, rate, ridge, least)[0]


def grid_search(
    df: DataFrame, held: Column, features: Sequence[str], label: str, leaves: Sequence[int] = (7, 15, 31), trees: int = 200, rate: float = 0.05, ridge: float = 1.0, least: int = 20
) -> tuple[Forest, dict[int, float]]:
    """The forest of the number of leaves with the least RMSE on the held-out rows, the fewest of equals, refitted on all rows; and each RMSE.

    The refits grow along with the forests that are judged, in the same passes: two more of them to throw away cost less than
    as many passes again. The bins' edges are those of all rows.
    """
    models = [(k, False) for k in leaves] + [(k, True) for k in leaves]
    forests, errors = _grow(df, features, label, held, models, trees, rate, ridge, least)
    judged = dict(zip(leaves, errors))
    if any(e != e for e in judged.values()):
        raise ValueError("there are no rows to validate on")
    best = min(judged, key=lambda k: (judged[k], k))
    return forests[len(leaves) + list(leaves).index(best)], judged


def _sums(block: tuple, plans: list, wholes: list[bool], scale: float) -> list:
    """Each forest's histograms of the nodes that its plan wants, over one block."""
    out = []
    for (tree, wanted), residual, whole in zip(plans, block[2], wholes):
        if not wanted:
            out.append(None)
            continue
        rows = slice(None if whole else block[1])
        binned = block[0][rows]
        node = walked(tree, binned) if tree is not None else np.zeros(len(binned), np.int64)
        times = block[3][rows] if len(block) > 3 else None
        out.append(histograms(binned, np.rint(residual[rows] * scale), node, wanted, times))
    return out


def _added(a: list, b: list) -> list:
    return [x if y is None else x + y for x, y in zip(a, b)]


def _learn(tree: Tree, wanted: list[int], sums, ridge: float, least: int) -> None:
    """Give the wanted nodes and their siblings their histograms and best splits."""
    if not tree.nodes:
        tree.nodes.append(Node(float(sums[0][0, :, 0].sum()), int(sums[0][0, :, 1].sum())))
    parents = {c: (n, sum(n.children) - c) for n in tree.nodes if n.children for c in n.children}
    for k, own in zip(wanted, sums if sums is not None else ()):
        made = [(tree.nodes[k], own)]
        if k in parents:
            parent, other = parents[k]
            made.append((tree.nodes[other], parent.histogram - own))
        for node, histogram in made:
            node.histogram = histogram
            node.split = best_split(node, ridge, least)
