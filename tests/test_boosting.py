"""Leaf-wise boosting against a plain version that grows one node at a time over whole columns."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import boosting


def plain(x, y, leaves, trees, rate=0.05, ridge=1.0, least=20):
    """x: whole bins, -1 for missing. The best gain is split first; predictions after all trees."""
    guess = np.full(len(y), y.mean())

    def best(rows, g):
        found = None
        total, n = g[rows].sum(), len(rows)
        for missing_left in (False, True):
            for f in range(x.shape[1]):
                column = x[rows, f]
                if missing_left and not (column < 0).any():
                    continue
                for at in range(255):
                    left = (column <= at) & (column >= 0) | (column < 0) & missing_left
                    a = left.sum()
                    if a < least or n - a < least:
                        continue
                    s = g[rows][left].sum()
                    gain = s * s / (a + ridge) + (total - s) ** 2 / (n - a + ridge) - total**2 / (n + ridge)
                    if gain > (found[0] + 1e-7 if found else 1e-7):
                        found = (gain, f, at, left)
        return found

    for _ in range(trees):
        g = y - guess
        open_, done, order = [], [np.arange(len(y))], 0
        if first := best(done[0], g):
            open_ = [(-first[0], order, 0, first)]
        while open_ and len(done) < leaves:
            _, _, k, (_, _, _, left) = heapq.heappop(open_)
            rows = done[k]
            done[k] = rows[left]
            done.append(rows[~left])
            for place in (k, len(done) - 1):
                if split := best(done[place], g):
                    order += 1
                    heapq.heappush(open_, (-split[0], order, place, split))
        for rows in done:
            guess[rows] += rate * g[rows].sum() / (len(rows) + ridge)
    return guess


def made(rng, n=400):
    x = rng.integers(0, 14, (n, 3)).astype(float)
    x[rng.random(n) < 0.1, 1] = np.nan
    y = np.where(x[:, 0] > 6, 3.0, 0.0) + np.where(np.isnan(x[:, 1]), 2.5, x[:, 1] * 0.2) * x[:, 2] + rng.normal(0, 0.7, n)
    return x, y


@pytest.mark.parametrize("one_task", [0, 1 << 16])
def test_forests_equal_a_plain_version(spark, monkeypatch, one_task):
    monkeypatch.setattr(boosting, "ONE_TASK", one_task)
    monkeypatch.setattr(boosting, "CUT_AFTER", 2)
    x, y = made(np.random.default_rng(3))
    rows = [(i, *(None if v != v else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(5)
    bins = np.where(np.isnan(x), -1, x).astype(int)
    for forest in boosting.boost(df, ["a", "b", "c"], "y", (4, 9, 15), trees=6):
        got = {r.id: r.prediction for r in forest.transform(df).collect()}
        want = plain(bins, y, forest.leaves, 6)
        assert [got[i] for i in range(len(y))] == pytest.approx(want.tolist(), abs=1e-6), forest.leaves
        assert all((t[:, 0] < 0).sum() <= forest.leaves for t in forest.trees) and len(forest.trees) == 6


def test_held_out_rows_judge_and_are_learned_from_in_the_end(spark, monkeypatch):
    x, y = made(np.random.default_rng(6))
    held = np.arange(len(y)) % 4 == 1
    rows = [(i, *(None if v != v else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(3)
    forest, errors = boosting.grid_search(df, F.col("id") % 4 == 1, ["a", "b", "c"], "y", (3, 12), trees=8)
    monkeypatch.setattr(boosting, "ONE_TASK", 0)
    passes, again = boosting.grid_search(df, F.col("id") % 4 == 1, ["a", "b", "c"], "y", (3, 12), trees=8)
    assert again == pytest.approx(errors) and all((s == t).all() for s, t in zip(forest.trees, passes.trees))
    bins = np.where(np.isnan(x), -1, x).astype(int)
    judged = {k: boosting.boost(df.filter("id % 4 <> 1"), ["a", "b", "c"], "y", [k], trees=8)[0] for k in (3, 12)}
    for k, f in judged.items():
        p = {r.id: r.prediction for r in f.transform(df.filter("id % 4 = 1")).collect()}
        assert errors[k] == pytest.approx(np.sqrt(np.mean([(p[i] - y[i]) ** 2 for i in np.flatnonzero(held)])), abs=1e-9)
    got = {r.id: r.prediction for r in forest.transform(df).collect()}
    assert forest.leaves == min(errors, key=errors.get)
    assert [got[i] for i in range(len(y))] == pytest.approx(plain(bins, y, forest.leaves, 8).tolist(), abs=1e-6)


def test_trees_do_not_depend_on_partitions(spark, monkeypatch):
    x, y = made(np.random.default_rng(4), 700)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    one = boosting.boost(df.repartition(1), ["a", "b", "c"], "y", [8], trees=4)[0]
    monkeypatch.setattr(boosting, "ONE_TASK", 0)
    other = boosting.boost(df.repartition(7, "c"), ["a", "b", "c"], "y", [8], trees=4)[0]
    assert all((s == t).all() for s, t in zip(one.trees, other.trees))


def test_speculative_growth_takes_the_best_gains_first():
    """Trees over random gains: the same splits as one node at a time."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        gains = rng.random(400)
        tree, names = boosting.Tree(12), {0: 1}
        tree.nodes.append(boosting.Node(0.0, 10, np.zeros(1), (float(gains[1]), 0, 0, 0, 0.0, 5)))
        passes = 0
        while True:
            order, unknown = tree.expand()
            if not unknown:
                break
            passes += 1
            for k in unknown:
                for side, c in enumerate(tree.nodes[k].children):
                    names[c] = 2 * names[k] + side
                    gain = gains[names[c]] if names[c] < 400 and gains[names[c]] > 0.2 else None
                    tree.nodes[c].histogram = np.zeros(1)
                    tree.nodes[c].split = (float(gain), 0, 0, 0, 0.0, 5) if gain else None
        heap, want = [(-gains[1], 1)], []
        while heap and len(want) + 1 < 12:
            _, k = heapq.heappop(heap)
            want.append(k)
            for c in (2 * k, 2 * k + 1):
                if c < 400 and gains[c] > 0.2:
                    heapq.heappush(heap, (-gains[c], c))
        # Children of the last splits may be without a name: nobody asks for them.
        for k in order:
            for side, c in enumerate(tree.nodes[k].children):
                names.setdefault(c, 2 * names[k] + side)
        assert [names[k] for k in order] == want and passes <= len(want)


def test_the_fewest_leaves_win_ties_and_cases(spark):
    df = spark.createDataFrame([(i, float(i % 2), float(i % 2)) for i in range(200)], "id int, x double, y double")
    forest, errors = boosting.grid_search(df, F.col("id") % 5 == 0, ["x"], "y", (2, 3, 4), trees=30)
    assert forest.leaves == 2 and len(set(errors.values())) == 1 and len(forest.trees) == 30
    out = forest.transform(df.withColumn("prediction", df.id)).collect()
    assert len(out) == 200 and all((r.prediction > 0.5) == (r.y > 0.5) for r in out)
    flat = boosting.boost(df.withColumn("y", df.y * 0 + 7), ["x"], "y", [4], trees=2)[0]
    assert {r.prediction for r in flat.transform(df).collect()} == {7.0}
    with pytest.raises(ValueError, match="1 of 3"):
        boosting.boost(spark.createDataFrame([(1.0, 1.0), (1.0, None), (2.0, 3.0)], "x double, y double"), ["x"], "y")
    with pytest.raises(ValueError, match="0 of 0"):
        boosting.boost(df.limit(0), ["x"], "y")
    with pytest.raises(ValueError, match="no rows to validate"):
        boosting.grid_search(df, F.lit(False), ["x"], "y", [2], trees=1)


def grown(rng, leaves, features=3):
    tree = boosting.Tree(leaves, [boosting.Node(0.0, 10)])
    for _ in range(leaves - 1):
        k = int(rng.choice([i for i, n in enumerate(tree.nodes) if n.children is None]))
        tree.nodes[k].split = (1.0, int(rng.integers(features)), int(rng.integers(boosting.BINS)), int(rng.integers(2)), 0.0, 5)
        tree.nodes[k].children = (len(tree.nodes), len(tree.nodes) + 1)
        tree.nodes += [boosting.Node(0.0, 5), boosting.Node(0.0, 5)]
    return tree.arrays([k for k, n in enumerate(tree.nodes) if n.children])


def test_rows_find_their_leaf_by_a_look_for_each_feature(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(boosting, "CHUNK", 100)
    x = rng.integers(0, boosting.BINS + 1, (350, 3)).astype(np.uint8)
    x[::9] = boosting.BINS
    for leaves in (1, 2, 7, 31, 64, 65, 90):
        tree = grown(rng, leaves)
        assert (boosting.walked(tree, x) == boosting._by_steps(tree, x)).all(), leaves
    node, r = rng.integers(0, 5, 350), rng.integers(-9, 9, 350).astype(float)
    got = boosting.histograms(x, r, node, [4, 1])
    for k, w in enumerate([4, 1]):
        for f in range(3):
            here = node == w
            assert (got[k, f, :, 0] == np.bincount(x[here, f], r[here], 256)).all() and (got[k, f, :, 1] == np.bincount(x[here, f], minlength=256)).all()


def test_the_child_of_fewer_rows_is_summed():
    plans, rng = [], np.random.default_rng(9)
    x = np.where(rng.random((3000, 1)) < 0.9, 3, rng.integers(0, 200, (3000, 1))).astype(np.uint8)
    block = (x, 3000, (x[:, 0] * 1.0 + (x[:, 0] > 90) * 500)[None])

    def summed(wanted):
        plans.append(wanted)
        return boosting._sums(block, wanted, [True], 1.0)

    boosting._trees([8], summed, lambda total, rows: total / rows, 1.0, 20)
    rows = [np.isin(boosting.walked(tree, x), wanted).sum() for ((tree, wanted),) in plans[1:] if wanted]
    assert rows and max(rows) <= 1500


def test_rows_of_equal_bins_are_one_cell(spark, monkeypatch):
    rng = np.random.default_rng(12)
    x, _ = made(rng, 150)
    x, part = np.repeat(x, 8, axis=0), np.arange(1200) % 4
    y = x[:, 0] * 0.3 + np.nan_to_num(x[:, 1]) * 0.2 + rng.normal(0, 0.7, 1200)
    rows = [(int(p), *(None if v != v else float(v) for v in r), float(t)) for p, r, t in zip(part, x, y)]
    df = spark.createDataFrame(rows, "part int, a double, b double, c double, y double").repartition(3)
    bins = np.where(np.isnan(x), -1, x).astype(int)
    found = []
    for one_task in (0, 300):  # there are at most 300 cells: those of the rows that are held out, and of the others
        monkeypatch.setattr(boosting, "ONE_TASK", one_task)
        if one_task:
            monkeypatch.setattr(boosting, "_trees", lambda *a: pytest.fail("a pass over all tasks for each step, for 1,200 rows of 300 cells"))
        found.append(boosting.grid_search(df, F.col("part") == 1, ["a", "b", "c"], "y", (3, 9), trees=5))
    (passes, errors), (alone, again) = found
    assert again == pytest.approx(errors) and all((s == t).all() for s, t in zip(alone.trees, passes.trees))
    got = [r.prediction for r in alone.transform(spark.createDataFrame(rows, df.schema).coalesce(1)).collect()]
    assert got == pytest.approx(plain(bins, y, alone.leaves, 5).tolist(), abs=1e-6)
    monkeypatch.undo()
    for k in (3, 9):
        p = boosting.boost(df.filter("part <> 1"), ["a", "b", "c"], "y", [k], trees=5)[0].transform(df.filter("part = 1"))
        assert errors[k] == pytest.approx(p.selectExpr("sqrt(avg(pow(y - prediction, 2)))").first()[0], abs=1e-9)


def test_edges_are_exact_quantiles(spark):
    rng, n = np.random.default_rng(13), 3000
    columns = [rng.normal(0, 1, n) ** 7, rng.integers(-3, 4, n) * 1.0, 10.0 ** rng.uniform(-300, 300, n), np.where(rng.random(n) < 0.5, -0.0, 1e-310), np.full(n, np.nan), np.arange(n) * 1.0]
    columns[0][::7], columns[2][::5], columns[5][1:] = np.nan, -np.inf, np.inf
    rows = [tuple(None if v != v and i % 2 else float(v) for v in r) for i, r in enumerate(zip(*columns))]
    names = list("abcdef")
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    for column, got in zip(columns, boosting.bin_edges(df, names)):
        v = np.sort(column[np.isfinite(column)])
        at = (len(v) - 1) * np.array([i / 255 for i in range(1, 255)])
        low, high = np.floor(at), np.ceil(at)
        want = np.where(low == high, v[low.astype(int)], (high - at) * v[low.astype(int)] + (at - low) * v[high.astype(int)]) if len(v) else v
        assert got.tolist() == np.unique(want).tolist()


def test_small_blocks_are_merged(monkeypatch):
    rng = np.random.default_rng(14)
    monkeypatch.setattr(boosting, "ROWS", 50)
    blocks = []
    for size in (7, 1, 30, 2, 25, 60, 4):
        n = [rng.integers(1, 9, size)] if size % 2 == 0 else []
        blocks.append((rng.integers(0, 256, (size, 2)).astype(np.uint8), int(rng.integers(0, size + 1)), rng.normal(0, 9, (3, size)).round(), *n))
    made = list(boosting._merged(blocks))
    assert len(made) < len(blocks) and sorted({len(b) for b in made}) == [3, 4]
    wholes = [False, True, True]
    sums = lambda some: [sum(x) for x in zip(*(boosting._sums(b, [(None, [0])] * 3, wholes, 1.0) for b in some))]
    for got, want in zip(sums(made), sums(blocks)):
        assert (got == want).all()
    assert sum(boosting._held_out(b) for b in made) == pytest.approx(sum(boosting._held_out(b) for b in blocks))
