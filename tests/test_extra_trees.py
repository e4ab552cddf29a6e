"""Extremely randomised trees against a plain recursion over the same draws."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hourweave.operators import extra_trees as X
from hourweave.operators import models as M

COLUMNS = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    made = []
    for i in range(600):
        a, b, c = (float(v) for v in rng.normal(size=3))
        made.append((i, ("train", "train", "val")[i % 3], a, round(b, 1), c, 1.0, 1e6 + 10 * (a > 0.3) + 5 * b + 0.1 * float(rng.normal())))
    return spark.createDataFrame(made, "id int, split string, a double, b double, c double, flat double, DART double").cache()


def _draws(spark, seed, trees, nodes, width):
    own = [F.col("t"), F.col("n")]
    grid = spark.range(trees).select(F.col("id").cast("int").alias("t")).select("t", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("n"))
    table = grid.select("t", "n", *[X.draw(seed, F.lit(kind), *own, F.lit(i)).alias(f"{kind}{i}") for i in range(width) for kind in ("order", "cut")])
    return {(r.t, r.n): r for r in table.collect()}


def _plain(x, y, tree, draws, depth, min_split, min_leaf, wanted):
    """Nodes of one tree, numbered level by level as they are cut; (feature, cut, value) each."""
    nodes, open_now = [None], [(0, np.arange(len(y)))]
    for level in range(depth + 1):
        after = []
        for number, at in open_now:
            best, d = None, draws[tree, number]
            if level < depth and len(at) >= max(min_split, 2 * min_leaf):
                varying = [i for i in range(x.shape[1]) if x[at, i].min() < x[at, i].max()]
                for i in sorted(sorted(varying, key=lambda i: d[f"order{i}"])[:wanted]):
                    low, high = x[at, i].min(), x[at, i].max()
                    cut = low + d[f"cut{i}"] * (high - low)
                    left, right = at[x[at, i] <= cut], at[x[at, i] > cut]
                    if min(len(left), len(right)) < min_leaf:
                        continue
                    lost = sum(((y[s] - y[s].mean()) ** 2).sum() for s in (left, right))
                    gain = ((y[at] - y[at].mean()) ** 2).sum() - lost
                    if best is None or gain > best[0]:
                        best = (gain, i, cut, left, right)
            nodes[number] = (best[1] if best else X.LEAF, best[2] if best else None, y[at].mean())
            if best:
                for side in best[3:]:
                    after.append((len(nodes), side))
                    nodes.append(None)
        open_now = after
    return nodes


@pytest.mark.parametrize(("depth", "share"), [(0, "sqrt"), (4, "sqrt"), (3, 1.0)])
def test_nodes_equal_a_plain_recursion(spark, rows, depth, share):
    model = M.fit(rows, COLUMNS, X.ExtraTrees("DART", trees=3, depth=depth, min_split=20, min_leaf=8, share=share, seed=7)).stages[-1]
    train = rows.where("split = 'train'").toPandas()
    draws = _draws(spark, 7, 3, 2 ** (depth + 1), len(COLUMNS))
    wanted = 2 if share == "sqrt" else 4
    for t in range(3):
        plain = _plain(train[COLUMNS].to_numpy(), train.DART.to_numpy(), t, draws, depth, 20, 8, wanted)
        assert [n.feature for n in model.trees[t]] == [p[0] for p in plain]
        for ours, (feature, cut, value) in zip(model.trees[t], plain):
            assert ours.value == pytest.approx(value, abs=1e-6)
            if feature >= 0:
                assert ours.cut == pytest.approx(cut, abs=1e-12)


def test_every_row_trains_every_tree_and_leaves_keep_their_size(rows):
    model = M.fit(rows, COLUMNS, X.ExtraTrees("DART", trees=5, depth=6, min_split=40, min_leaf=20)).stages[-1]
    train = rows.where("split = 'train'").toPandas()
    x = train[COLUMNS].to_numpy()
    for nodes in model.trees:
        place = np.zeros(len(x), int)
        for _ in range(6):
            for r, n in enumerate(place):
                if nodes[n].feature >= 0:
                    place[r] = nodes[n].below if x[r, nodes[n].feature] <= nodes[n].cut else nodes[n].above
        sizes = np.unique(place, return_counts=True)
        assert sizes[1].min() >= 20 and sizes[1].sum() == 400
        assert all(nodes[n].feature == X.LEAF for n in sizes[0])


def test_learns_and_reloads(spark, rows, tmp_path):
    model = M.fit(rows, COLUMNS, M.extra_trees("DART", trees=20, depth=8, min_split=20, min_leaf=5))
    scored = M.predict(model, rows, "extra_trees", "DART", keys=("id",))
    errors = scored.where("split = 'val'").agg(F.avg((F.col("y") - F.col("prediction")) ** 2).alias("own"), F.var_pop("y").alias("mean")).first()
    assert errors.own < 0.5 * errors["mean"]
    weights = model.stages[-1].featureImportances.toArray()
    assert math.isclose(weights.sum(), 1.0) and weights[3] == 0 and weights[2] < min(weights[:2])
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.stages[-1].trees == model.stages[-1].trees and again.stages[-1].uid == model.stages[-1].uid
    assert M.predict(again, rows, "extra_trees", "DART", keys=("id",)).exceptAll(scored).isEmpty()


def test_edge_rows(spark):
    one = spark.createDataFrame([(Vectors.dense([1.0]), 3.0), (Vectors.dense([2.0]), None)], ["features", "y"])
    model = X.ExtraTrees("y", trees=2, min_leaf=1, min_split=1).fit(one)
    assert {r.prediction for r in model.transform(one).collect()} == {3.0}
    with pytest.raises(ValueError, match="no rows"):
        X.ExtraTrees("y").fit(one.where("y is null"))
    with pytest.raises(ValueError, match="depth"):
        X.ExtraTrees("y", depth=60)


def test_no_python_and_no_forest_in_rows(spark, rows):
    model = M.fit(rows, COLUMNS, X.ExtraTrees("DART", trees=2, depth=2, min_split=20, min_leaf=8))
    plan = model.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Subquery" not in plan
