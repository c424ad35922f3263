"""Histogram trees against a plain recursion over the same bins and samples."""

import os
import shutil
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from lapwise.learn import trees as T

NEWTON = T.TreeSettings(trees=6, depth=3, rate=0.3, row_share=0.8, column_share=0.75, least_weight=2, l2=1, newton=True)
SETTINGS = {
    "second order": NEWTON,
    "second order, logistic": replace(NEWTON, logistic=True, least_weight=0.5),
    "with penalties": replace(NEWTON, logistic=True, least_weight=0.5, l1=0.4, least_gain=0.3),
    "first order": T.TreeSettings(trees=5, depth=3, rate=0.2, row_share=0.7, least_rows=8),
    "first order, logistic": T.TreeSettings(trees=5, depth=2, rate=0.2, least_rows=8, logistic=True),
    "forest": T.TreeSettings(trees=5, depth=4, least_rows=5, boosted=False),
    "forest of classes": T.TreeSettings(trees=5, depth=4, least_rows=2, boosted=False, logistic=True, root_columns=True),
}


def table(spark, rows=400, seed=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(rows, 4)).round(2)
    y = 2 * x[:, 0] - x[:, 1] ** 2 + 0.3 * r.normal(size=rows)
    data = [(*map(float, row), float(v), float(v > 0)) for row, v in zip(x, y)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, y double, k double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)


def blocks_of(matrix):
    rows = sorted(matrix.stored.collect(), key=lambda r: r["number"])
    out = []
    for r in rows:
        y = np.frombuffer(r["y"])
        out.append((r["number"], np.frombuffer(r["codes"], np.uint8).reshape(len(matrix.edges), len(y)), y))
    return out


def plain_ensemble(blocks, s):
    """Leaf sums (boosted, with the start) or means (bagged) of all rows, by recursion over nodes and loops over cuts."""
    codes = np.concatenate([c for _, c, _ in blocks], axis=1)
    y = np.concatenate([v for _, _, v in blocks])
    margin = np.full(len(y), s.start(y.mean()))
    total = np.zeros(len(y))
    soft = lambda g: np.sign(g) * max(abs(g) - (s.l1 if s.newton else 0), 0)

    for tree in range(s.trees):
        weight = np.concatenate([T.row_weights(s, tree, number, len(v)) for number, _, v in blocks])
        if not s.boosted:
            g, h = -y, np.ones(len(y))
        elif s.logistic:
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
        else:
            g, h = margin - y, np.ones(len(y))
        g, h = g * weight, h * weight

        def leaf(rows):
            G, H, N = g[rows].sum(), h[rows].sum(), weight[rows].sum()
            if not s.boosted:
                return -G / N
            return -soft(G) / (H + s.l2) * s.rate if s.newton else -G / H * s.rate

        def score(rows):
            w = h[rows].sum() + s.l2 if s.newton else weight[rows].sum()
            return soft(g[rows].sum()) ** 2 / w

        def descend(rows, level, number):
            value = np.zeros(len(y))
            best = (1e-9, None, None)
            used = rows & (weight > 0)
            if level < s.depth:
                allowed = T.allowed_columns(s, len(codes), tree, number)
                for f in np.flatnonzero(allowed):
                    for cut in range(T.BINS - 1):
                        low, high = used & (codes[f] <= cut), used & (codes[f] > cut)
                        sides = [h[low].sum(), h[high].sum()] if s.newton else [weight[low].sum(), weight[high].sum()]
                        if min(sides) < (s.least_weight if s.newton else s.least_rows):
                            continue
                        gain = score(low) + score(high) - score(used)
                        if gain > best[0] + 1e-12:
                            best = (gain, f, cut)
            if best[1] is None or best[0] < s.least_gain:
                value[rows] = leaf(used)
                return value
            low = codes[best[1]] <= best[2]
            return descend(rows & low, level + 1, 2 * number) + descend(rows & ~low, level + 1, 2 * number + 1)

        value = descend(np.ones(len(y), bool), 0, 1)
        margin, total = margin + value, total + value
    return margin if s.boosted else total / s.trees


@pytest.mark.parametrize("name", list(SETTINGS))
def test_margins_are_those_of_a_plain_recursion(spark, name):
    s = SETTINGS[name]
    matrix = T.binned(table(spark), "k" if s.logistic else "y", 4)
    model = T.fit_ensembles(matrix, [s])[0]
    blocks = blocks_of(matrix)
    got = np.zeros(sum(len(y) for *_, y in blocks))
    codes = np.concatenate([c for _, c, _ in blocks], axis=1)
    for tree in model.trees:
        got += T.Tree.values_of(tree.packed(), codes)
    got = got + model.base if s.boosted else got / len(model.trees)
    assert len(model.trees) == s.trees and any((t.feature >= 0).any() for t in model.trees)
    np.testing.assert_allclose(got, plain_ensemble(blocks, s), atol=1e-9)


def test_many_partitions_grow_the_same_trees(spark, monkeypatch):
    """Side by side, with exchanged sums, broadcast and checkpointed trees, as in one task."""
    settings = list(SETTINGS.values())
    for label, chosen in (("y", [s for s in settings if not s.logistic]), ("k", [s for s in settings if s.logistic])):
        matrix = T.binned(table(spark).repartition(3), label, 4)
        alone = T.fit_ensembles(matrix, chosen)
        with monkeypatch.context() as m:
            for name, value in (("ROWS_PER_TASK", 150), ("TAIL", 3), ("CHECKPOINT_TREES", 2)):
                m.setattr(T, name, value)
            assert matrix.blocks({}).getNumPartitions() == 3
            many = T.fit_ensembles(matrix, chosen)
        values = np.random.default_rng(1).normal(size=(300, 4))
        for a, b in zip(alone, many):
            assert [t.feature.tolist() for t in a.trees] == [t.feature.tolist() for t in b.trees]
            np.testing.assert_allclose(a.margins(values), b.margins(values), atol=1e-9)


def test_penalties_shrink(spark):
    matrix = T.binned(table(spark), "k", 4)
    plain, gain, l1 = T.fit_ensembles(matrix, [
        SETTINGS["second order, logistic"], replace(SETTINGS["second order, logistic"], least_gain=5.0),
        replace(SETTINGS["second order, logistic"], l1=5.0)])
    leaves = lambda m: sum((t.feature < 0).sum() for t in m.trees)
    size = lambda m: max(np.abs(t.value).max() for t in m.trees)
    assert leaves(gain) < leaves(plain) and size(l1) < size(plain)


def test_models_are_stored_as_tables(spark, tmp_path):
    df = table(spark)
    matrix = T.binned(df, "k", 4)
    for k, s in enumerate((SETTINGS["with penalties"], SETTINGS["forest of classes"])):
        model = T.fit_ensembles(matrix, [s])[0]
        model.save(f"file://{tmp_path}/{k}")
        again = T.TreeModel.load(f"file://{tmp_path}/{k}")
        assert again.settings == s
        a, b = model.transform(df), again.transform(df)
        assert a.exceptAll(b).count() == 0
        right = a.filter("prediction = k").count()
        assert right > 300
        assert abs(model.importances().sum() - 1) < 1e-12
        nodes = model.nodes().collect()
        assert all((r["feature"] is None) == (r["left"] is None) for r in nodes) and max(r["tree"] for r in nodes) == s.trees - 1


def test_a_new_value_goes_the_way_of_its_bin(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(k % 4), float(k % 4 >= 2)) for k in range(80)], "x double, y double"))
    model = T.fit_ensembles(T.binned(df, "y", 1), [T.TreeSettings(trees=1, depth=1, boosted=False, least_rows=1)])[0]
    assert model.scores(np.array([[-9.0], [1.0], [1.5], [2.0], [99.0]])).round(6).tolist() == [0, 0, 1, 1, 1]


def test_no_rows_and_one_class(spark):
    df = table(spark)
    for s in (SETTINGS["first order"], SETTINGS["forest"]):
        model = T.fit_ensembles(T.binned(df.limit(0), "y", 4), [s])[0]
        assert model.trees == [] and model.scores(np.zeros((2, 4))).tolist() == [0, 0]
    one = df.selectExpr("features", "0.0D AS k")
    scores = T.fit_ensembles(T.binned(one, "k", 4), [SETTINGS["first order, logistic"]])[0].scores(np.zeros((1, 4)))
    assert scores[0] < 1e-6


def test_partitions_follow_the_cores_and_not_the_rows(spark, monkeypatch):
    """Many rows a core stay one partition each, so that the exchanged sums do not grow with the table; blocks are joined."""
    matrix = T.binned(table(spark).repartition(40), "y", 4)
    assert matrix.blocks({}).getNumPartitions() == 1 and len(matrix.blocks({}).collect()) == 1
    monkeypatch.setattr(T, "ROWS_PER_TASK", 200)
    monkeypatch.setattr(T, "BLOCK_ROWS", 20)
    blocks = matrix.blocks({}).collect()
    assert matrix.blocks({}).getNumPartitions() == 4
    assert sum(len(b.y) for b in blocks) == 400 and len(blocks) < 40
    monkeypatch.setattr(T, "ROWS_PER_TASK", 40)
    assert matrix.blocks({}).getNumPartitions() == 10


def test_tasks_remember_only_what_a_later_job_needs(spark):
    matrix = T.binned(table(spark), "y", 4)
    block = matrix.blocks({0: matrix.mean}).collect()
    one = T.TreeSettings(trees=1, depth=1)
    forest = SETTINGS["forest"]
    for s, request in ((one, T.Request(0, 0, [], [1])), (forest, T.Request(-1, 0, [], [1]))):
        list(T._partition_sums("alone", 0, [s], {0: request}, T.Log(T.TAIL, [], []), iter(block)))
        assert not [k for k in T._MEMORY if k[0] == "alone"]


def test_second_order_trees_do_not_count_rows():
    """Their splits weigh by the Hessian, so the sums of rows would go unread."""
    r = np.random.default_rng(4)
    block = T.Block(0, r.integers(0, T.BINS, (3, 50)).astype(np.uint8), r.integers(0, 2, 50).astype(float), {}, [(0, 50)])
    settings = replace(NEWTON, logistic=True, column_share=1)
    growing = T.Growing(block, settings, np.zeros(50), 0)
    sums = growing.sums(1, settings)
    assert sums[0, 1, 0].sum() == pytest.approx(growing.planes[1].sum()) and not sums[:, 2].any()
    # First-order splits still weigh by rows.
    assert growing.sums(1, replace(settings, newton=False))[0, 2, 0].sum() == growing.planes[2].sum()


def test_a_tree_of_a_forest_keeps_its_rows_between_levels(monkeypatch):
    """In one task each block starts a tree once, and only one tree's rows are held; the trees are those of one level at a time."""
    r = np.random.default_rng(4)
    codes, y = r.integers(0, T.BINS, (4, 900)).astype(np.uint8), r.normal(size=900)
    blocks = [T.Block(k, codes[:, k * 300 : k * 300 + 300], y[k * 300 : k * 300 + 300], {}, [(k, 300)]) for k in range(3)]
    settings = replace(SETTINGS["forest"], trees=1)
    started, held, plain = [], [], T._level_sums
    make = T.Growing
    monkeypatch.setattr(T, "Growing", lambda *a: started.append(1) or make(*a))

    def sums(settings, requests, log, memories, *bagged):
        out = plain(settings, requests, log, memories, *bagged)
        held.append(max(len(m.growing) for m in memories))
        return out

    monkeypatch.setattr(T, "_level_sums", sums)
    got = list(T._grow_here([T.Grower(settings, 4, -1, first) for first in range(5)], iter(blocks)))[0]
    assert len(started) == 5 * len(blocks) and max(held) == 1
    for first, (tree,) in enumerate(got):
        grower = T.Grower(settings, 4, -1, first)
        while not grower.done:
            requests = {0: grower.request()}
            whole = plain([settings], requests, T.Log(T.TAIL, [], []), [T.Remembered(b) for b in blocks])
            T._advance([grower], requests, [T._splits([settings], 4, requests, ((0, 0), whole[0]))], T.Log(T.TAIL, [], []))
        assert all(np.array_equal(a, b) for a, b in zip(tree.__dict__.values(), grower.trees[0].__dict__.values()))


def grown_here(settings, codes, y, size=300):
    blocks = [T.Block(k, codes[:, k : k + size], y[k : k + size], {0: np.full(len(y[k : k + size]), settings.start(y.mean()))}, [(k, len(y[k : k + size]))])
              for k in range(0, len(y), size)]
    growers = [T.Grower(settings, len(codes), 0)] if settings.boosted else [
        T.Grower(replace(settings, trees=1), len(codes), -1, first) for first in range(settings.trees)]
    return [tree for trees in next(T._grow_here(growers, iter(blocks))) for tree in trees]


@pytest.mark.parametrize("name", list(SETTINGS))
def test_only_smaller_children_are_added_up(monkeypatch, name):
    """Sums of a large node's sibling follow from their parent; the trees are those of whole sums."""
    r = np.random.default_rng(6)
    codes = r.integers(0, T.BINS, (5, 900)).astype(np.uint8)
    y = (codes[0] > 20) + 0.02 * codes[1] + r.normal(size=900)
    y = (y > 1.5).astype(float) if SETTINGS[name].logistic else y
    added, add = [], T.Growing._add
    monkeypatch.setattr(T.Growing, "_add", lambda self, out, rows, *a: added.append(len(rows)) or add(self, out, rows, *a))
    plain, whole = grown_here(SETTINGS[name], codes, y), sum(added)
    added.clear()
    monkeypatch.setattr(T, "SIBLING_ROWS", 1)
    quick = grown_here(SETTINGS[name], codes, y)
    for a, b in zip(plain, quick, strict=True):
        assert a.feature.tolist() == b.feature.tolist() and a.cut.tolist() == b.cut.tolist()
        np.testing.assert_allclose(a.value, b.value, atol=1e-9)
    # Nodes of a tree that draw their own features have nothing in common with their parents.
    assert sum(added) == whole if SETTINGS[name].root_columns else sum(added) < 0.8 * whole


def test_nodes_sum_only_the_features_they_draw(monkeypatch):
    r = np.random.default_rng(6)
    codes, y = r.integers(0, T.BINS, (16, 600)).astype(np.uint8), r.integers(0, 2, 600).astype(float)
    block = T.Block(0, codes, y, {}, [(0, 600)])
    settings = SETTINGS["forest of classes"]
    sums = T.Growing(block, settings, 0.0, 0).sums(1, settings, [1])
    drawn = T.allowed_columns(settings, 16, 0, 1)
    drawn[0] = True
    assert drawn.sum() <= 5 and (sums[0, 2].any(axis=1) == drawn).all()


def test_rows_find_their_leaves_node_by_node(monkeypatch):
    r = np.random.default_rng(6)
    codes, y = r.integers(0, T.BINS, (5, 900)).astype(np.uint8), r.normal(size=900)
    for tree in grown_here(SETTINGS["forest"], codes, y):
        plain = T.Tree.values_of(tree.packed(), codes)
        with monkeypatch.context() as m:
            m.setattr(T, "NODE_ROWS", 1)
            assert (T.Tree.values_of(tree.packed(), codes) == plain).all()
    one = T.Tree(*[np.array([-1])] * 4, np.array([0.5]), np.array([0.0]))
    assert T.Tree.values_of(one.packed(), codes).tolist() == [0.5] * 900


def test_a_level_reads_files_and_writes_lost_ones_again(spark, monkeypatch):
    """Jobs go by handles, whichever worker they meet; files that are gone come back with the margins they need."""
    monkeypatch.setattr(T, "ROWS_PER_TASK", 150)
    matrix = T.binned(table(spark).repartition(3), "k", 4)
    settings = replace(SETTINGS["first order, logistic"], trees=4, row_share=0.7)
    blocks = matrix.blocks({0: settings.start(matrix.mean)})
    whole = T.fit_ensembles(matrix, [settings])[0].trees
    kept = T.KeptBlocks(blocks)
    folders = [h.folder for h in kept.handles.collect()]
    assert len(folders) == 3 and all(os.path.exists(f"{f}/codes.npy") for f in folders)
    grower = T.Grower(settings, 4, 0)
    advance, levels = T._advance, []

    def lose(*args):
        advance(*args)
        levels.append(len(args[0][0].trees))
        if len(levels) == 3:
            shutil.rmtree(folders[1])

    monkeypatch.setattr(T, "_advance", lose)
    T.grow(blocks, [grower], kept)
    assert len(levels) > 3 and [t.feature.tolist() for t in grower.trees] == [t.feature.tolist() for t in whole]
    np.testing.assert_allclose(np.concatenate([t.value for t in grower.trees]), np.concatenate([t.value for t in whole]), atol=1e-9)
    kept.drop()
    assert not any(os.path.exists(f) for f in folders)


def test_a_boosted_tree_goes_on_in_another_task(tmp_path):
    """From its file a tree has the rows, sums and parents that it had."""
    r = np.random.default_rng(6)
    codes, y = r.integers(0, T.BINS, (5, 900)).astype(np.uint8), r.integers(0, 2, 900).astype(float)
    settings = replace(SETTINGS["first order, logistic"], row_share=0.7, depth=4)
    margin = r.normal(size=900)
    block = T.Block(0, codes, y, {}, [(0, 900)])
    growing = T.Growing(block, settings, margin, 2)
    growing.sums(1, settings)
    growing.descend(np.array([[1], [30], [0], [1]]))
    growing.sums(2, settings)
    again = T.Growing(block, settings, margin, 2, growing.state())
    assert again.level == growing.level == 1 and again.parents == [0, 0]
    for (a, b), (c, d) in zip(growing.nodes, again.nodes, strict=True):
        assert (a == c).all() and (b == d).all()


def test_ensembles_of_a_search_share_the_draws_of_rows(monkeypatch):
    """Eight settings that grow the same tree hash the rows of a block once."""
    r = np.random.default_rng(6)
    codes, y = r.integers(0, T.BINS, (5, 900)).astype(np.uint8), r.integers(0, 2, 900).astype(float)
    block = T.Block(0, codes, y, {e: np.zeros(900) for e in range(8)}, [(77, 900)])
    settings = [replace(NEWTON, row_share=0.1 * (e + 1), seed=4711) for e in range(8)]
    hashed, plain = [], T.uniforms
    monkeypatch.setattr(T, "uniforms", lambda *parts: hashed.append(len(parts)) or plain(*parts))
    requests = {e: T.Request(e, 3, [], [1]) for e in range(8)}
    sums = T._level_sums(settings, requests, T.Log(T.TAIL, [], []), [T.Remembered(block)])
    # A row is drawn by seed, tree, block and number.
    assert hashed.count(4) == 1
    shares = [sums[e][0, 1, 0].sum() for e in range(8)]
    assert shares == sorted(shares) and shares[0] < shares[-1]


def test_small_sums_are_added_up_by_the_driver(spark, monkeypatch):
    """With and without an exchange, the trees are the same."""
    monkeypatch.setattr(T, "ROWS_PER_TASK", 150)
    matrix = T.binned(table(spark).repartition(3), "k", 4)
    settings = [replace(SETTINGS["second order, logistic"], trees=2), SETTINGS["forest of classes"]]
    few = T.fit_ensembles(matrix, settings)
    monkeypatch.setattr(T, "DRIVER_BYTES", 0)
    for a, b in zip(few, T.fit_ensembles(matrix, settings)):
        assert [t.feature.tolist() for t in a.trees] == [t.feature.tolist() for t in b.trees]
        np.testing.assert_allclose(np.concatenate([t.value for t in a.trees]), np.concatenate([t.value for t in b.trees]), atol=1e-9)
