"""Boosted quantiles against a plain loop, and what they must hold."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from hourweave.operators import metrics as X
from hourweave.operators import models as M
from hourweave.operators import pinball as P

LEVELS = (0.1, 0.5, 0.9)


def _ready(df):
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


@pytest.mark.parametrize("write_every", [25, 1])
def test_rounds_equal_a_plain_loop(spark, write_every):
    r = random.Random(4)
    rows = [(float(i % 2), r.gauss(100 * (i % 2), 5), "train") for i in range(300)]
    df = _ready(spark.createDataFrame(rows, "x double, DART double, split string"))
    estimator = M.gbt("DART", rounds=2, depth=1, step=0.5, min_leaf=1, share=1.0).setSubsamplingRate(1.0)
    model = P.fit_pinball(df, estimator, LEVELS, write_every=write_every)
    assert model.rounds() == 2
    got = {row.x: (row.a, row.b, row.c) for row in model.transform(df, ["a", "b", "c"]).select("x", "a", "b", "c").distinct().collect()}
    x, y = np.array([q[0] for q in rows]), np.array([q[1] for q in rows])
    for k, level in enumerate(LEVELS):
        score = np.full(len(y), np.quantile(y, level))
        for _ in range(2):
            rest = y - score
            push = np.where(rest > 0, level, level - 1)
            sides = [x == 0, x == 1]
            if np.isclose(push[sides[0]].mean(), push[sides[1]].mean()):
                sides = [x >= 0]
            for side in sides:
                score[side] += 0.5 * np.quantile(rest[side], level)
        assert [got[0.0][k], got[1.0][k]] == pytest.approx([score[x == 0][0], score[x == 1][0]])


def test_covers_and_widens(spark):
    r = random.Random(5)
    rows = [(x := r.random(), r.gauss(10 * x, 1 + 3 * x), "train" if i < 6000 else "val") for i in range(8000)]
    df = spark.createDataFrame(rows, "x double, DART double, split string")
    out = M.quantile_boosting(df, ["x"], M.gbt("DART", rounds=8, depth=3, step=0.5, min_leaf=100, share=1.0)).cache()
    val = out.where("split = 'val'")
    assert abs(X.interval_coverage(val, "p10", "p90", "DART").first().coverage - 0.8) < 0.02
    wide = {w.high: w.w for w in val.groupBy((F.col("x") > 0.5).alias("high")).agg(F.avg(F.col("p90") - F.col("p10")).alias("w")).collect()}
    assert wide[True] > 1.3 * wide[False]


def test_no_later_round_than_the_best_is_kept(spark):
    """A label that has nothing to do with the feature: validation losses soon stop falling."""
    r = random.Random(6)
    rows = [(r.random(), r.gauss(0, 1), "train" if i < 60 else "val") for i in range(400)]
    df = _ready(spark.createDataFrame(rows + [(0.5, None, "train")], "x double, DART double, split string"))
    model = P.fit_pinball(df, M.gbt("DART", rounds=30, depth=3, step=0.8, min_leaf=1, share=1.0), (0.5,), patience=2)
    assert model.rounds() < 8
    with pytest.raises(ValueError, match="no training rows"):
        P.fit_pinball(df.where("split = 'val'"), M.gbt("DART", rounds=1))
