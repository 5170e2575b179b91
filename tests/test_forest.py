import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from kotomori.operators import classify as C
from kotomori.operators import forest as FO

SMALL = replace(C.FOREST, trees=6, max_depth=7, partitions=3)


@pytest.fixture(scope="module")
def noisy(spark):
    """Sparse rows of three classes, some without a cell, with values below zero."""
    rng = random.Random(4)
    rows = []
    for i in range(240):
        y = rng.choice((0, 1, 1, 2))
        cells = {j: rng.choice((-0.5, 0.25, 1.0, rng.random())) + 0.2 * y for j in range(12) if rng.random() < 0.3}
        rows.append((i, y, Vectors.sparse(12, cells)))
    return C.training_frame(spark.createDataFrame(rows, ["id", "label_id", "features"]), "id", 3)


def trees(model):
    return model.toDebugString.split("\n")[1:]


@pytest.mark.parametrize("in_task", [4, 60])
def test_nodes_split_from_histograms_are_those_a_task_grows(noisy, in_task):
    spec = C.random_forest(SMALL).getStages()[0].spec
    whole, parts = (FO.Forest(spec, n).fit(noisy) for n in (None, in_task))
    assert trees(whole) == trees(parts) and len({t.depth for t in whole.trees}) >= 1 and whole.totalNumNodes > 60


def test_the_forest_is_a_model_of_spark_that_can_be_saved(noisy, tmp_path):
    model = C.fit(C.random_forest(SMALL), noisy)
    C.save_model(model, str(tmp_path / "m"))
    again = C.load_model(str(tmp_path / "m")).stages[-1]
    assert trees(again) == trees(model.stages[-1]) and again.getNumTrees == 6 and again.numClasses == 3
    assert again.getMaxDepth() == 7 and again.getFeaturesCol() == "features" and again.numFeatures == 12


def test_the_best_split_equals_every_split_tried():
    rng = np.random.default_rng(2)
    x, label = rng.integers(0, 4, (80, 5)), rng.integers(0, 3, 80)
    copies = rng.poisson(1.0, 80)
    weights, cuts = np.array([2.0, 0.5, 1.0]), np.array([0.5, 1.5, 2.5])
    growth = FO.Growth(3, weights, np.arange(6) * 3, np.tile(cuts, 5), 1, 5, 4, 1)
    size = (x > 0).sum(axis=1)
    index, value = np.nonzero(x)[1], x[x > 0].astype(float)
    rows = FO.Rows(label, copies, size, index, growth.bins(index, value))
    at, features = np.flatnonzero(copies), np.arange(5)

    def gini(w):
        return 1 - ((w / w.sum()) ** 2).sum()

    tried = []
    for f in range(5):
        for b in range(3):
            sides = [np.bincount(label[m], weights=copies[m], minlength=3) for m in (x[:, f] <= b, x[:, f] > b)]
            if min(s.sum() for s in sides) >= 4:
                w = [s * weights for s in sides]
                whole = w[0] + w[1]
                tried.append((gini(whole) - sum(gini(v) * v.sum() for v in w if v.sum()) / whole.sum(), f, b))
    for filed in (False, True):
        if filed:
            rows.file_by_feature(5)
        f, b, gain = growth.best(growth.histogram(rows, at, copies[at], features), features)
        assert (gain, f, b) == pytest.approx(max(tried))
        assert growth.goes_left(rows, at, f, b).tolist() == (x[at, f] <= b).tolist()


def test_thresholds_count_zeros_that_are_not_listed():
    assert FO.thresholds(np.array([1.0, 3.0, 1.0]), np.ones(3), 5.0, 31) == [0.5, 2.0]
    assert FO.thresholds(np.array([1.0, 3.0]), np.ones(2), 2.0, 31) == [2.0]
    many = FO.thresholds(np.arange(1000.0), np.ones(1000), 1000.0, 3)
    assert many == pytest.approx([250, 500, 750], abs=2)


@pytest.mark.parametrize("dense", [0, 40, 1 << 26])
@pytest.mark.parametrize("small, pairs", [(1, 1), (16, 200), (1 << 20, 1 << 20)])
def test_nodes_split_together_are_those_split_one_by_one(monkeypatch, dense, small, pairs):
    """Growth by level against one node after the other, by the histogram of each."""
    rng = np.random.default_rng(6)
    x, label, copies = rng.integers(0, 5, (150, 9)) * (rng.random((150, 9)) < 0.5), rng.integers(0, 3, 150), rng.poisson(1.0, 150)
    growth = FO.Growth(3, np.array([1.5, 0.5, 2.0]), np.arange(10) * 4, np.tile([0.5, 1.5, 2.5, 3.5], 9), 1, 6, 2, 3)
    index, value = np.nonzero(x)[1], x[x > 0].astype(float)
    rows = FO.Rows(label, copies, (x > 0).sum(axis=1), index, growth.bins(index, value))
    splits = {}

    def grow(at, node):
        counts = np.bincount(label[at], weights=copies[at], minlength=3).astype(np.int64)
        if growth.ends(counts, node.bit_length() - 1):
            return
        features = growth.drawn(5, node)
        best = growth.best(growth.histogram(rows, at, copies[at], features), features)
        if best is not None:
            f, b, gain = int(features[best[0]]), *best[1:]
            splits[node] = f, b, gain
            grow(at[x[at, f] <= b], 2 * node)
            grow(at[x[at, f] > b], 2 * node + 1)

    grow(np.flatnonzero(copies), 1)
    seen = {}
    for name, n in (("DENSE", dense), ("SMALL", small), ("PAIRS", pairs)):
        monkeypatch.setattr(FO, name, n)
    monkeypatch.setattr(FO.Growth, "listed", lambda self, root, counts, found: seen.update(found) or [])
    growth.grown(rows, 5, 1)
    assert len(seen) > 20 and {k: v[:2] for k, v in seen.items()} == {k: v[:2] for k, v in splits.items()}
    assert all(seen[k][2] == pytest.approx(splits[k][2]) for k in seen)


def test_a_cut_forest_is_the_one_grown_to_the_lower_limit(noisy):
    deep = [replace(SMALL, max_depth=d) for d in (7, 3, 30, 1)]
    models = C.fit_depths(deep, noisy)
    for c, model in zip(deep, models):
        alone = C.random_forest(c).fit(noisy)
        assert trees(model.stages[-1]) == trees(alone.stages[-1]) and model.stages[-1].totalNumNodes == alone.stages[-1].totalNumNodes
        assert model.stages[-1].getMaxDepth() == c.max_depth or C.depth_binds(models[2], c.max_depth) is False
    assert len({m.stages[-1].totalNumNodes for m in models}) > 2


def test_depths_of_a_family_are_grown_once(noisy, monkeypatch):
    grown = []
    whole = FO.Forest._grown
    monkeypatch.setattr(FO.Forest, "_grown", lambda self, *a: grown.append(a) or whole(self, *a))
    C.grid_search(noisy.drop("label", "class_weight"), "id", replace(SMALL, trees=2), {"max_depth": (6, 3, 2), "min_instances": (1, 2)}, k=2)
    assert len(grown) == 2 * 2 + 1


def scored(model, rows):
    return [tuple(r) for r in model.transform(rows).select("id", "rawPrediction", "probability", "prediction").orderBy("id").collect()]


@pytest.mark.parametrize("held", [1 << 24, 1])
def test_scores_by_node_arrays_are_those_of_sparks_model(noisy, monkeypatch, held):
    """Sparse and dense rows, and one without a cell; the model is not loaded into the driver for them."""
    monkeypatch.setattr(FO, "SCORED", held)
    model = C.fit(C.random_forest(SMALL), noisy).stages[-1]
    dense = noisy.sparkSession.createDataFrame([(1000 + i, Vectors.dense([x] * 12)) for i, x in enumerate((-1.0, 0.0, 0.3, 2.0))], ["id", "features"])
    rows = noisy.select("id", "features").unionByName(dense)
    found = scored(model, rows)
    assert "whole" not in model.held
    assert found == scored(model.whole, rows) and len({r[3] for r in found}) > 1


def test_a_model_is_saved_and_loaded_without_the_driver(noisy, tmp_path):
    """From the table of its nodes, over an older model, with what stands before the forest; Spark loads it too."""
    path = str(tmp_path / "m")
    for spec in (SMALL, replace(SMALL, select_top=5)):
        model = C.fit(C.random_forest(spec), noisy)
        C.save_model(model, path)
        again, whole = C.load_model(path), PipelineModel.load(path)
        assert scored(model, noisy) == scored(again, noisy) == scored(whole, noisy)
        assert all("whole" not in m.stages[-1].held for m in (model, again))
        assert [s.uid for s in whole.stages] == [s.uid for s in again.stages] and again.uid == whole.uid == model.uid
        assert again.stages[-1].getMaxDepth() == 7 and again.stages[-1].nodes.depth == max(t.depth for t in whole.stages[-1].trees)


def test_rows_of_many_cells_lower_the_rows_of_a_task(noisy, monkeypatch):
    spec, seen, whole = C.random_forest(SMALL).getStages()[0].spec, [], FO.Forest._tops
    monkeypatch.setattr(FO.Forest, "_tops", lambda self, *a: seen.append(a[-1]) or whole(self, *a))
    usual = FO.Forest(spec).fit(noisy)
    monkeypatch.setattr(FO, "IN_TASK_CELLS", 200)
    assert trees(FO.Forest(spec).fit(noisy)) == trees(usual)
    assert seen[0] == FO.IN_TASK and 1 < seen[1] < 100


def test_rows_of_a_tree_are_shuffled_once(noisy, monkeypatch):
    plans, whole = [], FO._subtrees
    monkeypatch.setattr(FO, "_subtrees", lambda *a: plans.append(whole(*a)) or plans[-1])
    C.random_forest(SMALL).fit(noisy)
    shuffles = [line for line in plans[0]._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]
    assert len(shuffles) == 1 and plans[0].rdd.getNumPartitions() == 2  # 6 trees, 4 to a task
