"""Boosted trees, one round at a time, stopped by the validation rows.

Each round fits one tree per target to the stored rows' residuals. What the trees since the last write add is one
transform over the stored table, so plans keep their size; every `WRITE_EVERY` rounds the scores are written again, which cuts
lineage and survives lost executors. No round is fitted twice, and none beyond the best round plus the patience.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.session import materialise

PATIENCE = 50
WRITE_EVERY = 25
#: The least probability that a log loss tells apart.
LEAST = 1e-15


def ensemble(spark: SparkSession, trees: Sequence, weights: Sequence[float], label: str) -> GBTRegressionModel:
    """MLlib's model of given trees (JVM objects) and weights; it predicts, explains and saves as a fitted one."""
    context = spark.sparkContext
    kind = context._jvm.org.apache.spark.ml.regression
    own = context._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    shares = context._gateway.new_array(context._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        own[i], shares[i] = tree, float(weight)
    model = kind.GBTRegressionModel(context._jvm.org.apache.spark.ml.util.Identifiable.randomUID("gbtr"), own, shares)
    model.set(model.getParam("labelCol"), label)
    return GBTRegressionModel(model)


def one_tree(estimator: GBTRegressor, seed: int, label: str) -> RandomForestRegressor:
    """The estimator's tree: rows sampled without replacement, a share of features per node."""
    return RandomForestRegressor(
        labelCol=label, featuresCol="features", numTrees=1, bootstrap=False, subsamplingRate=estimator.getSubsamplingRate(),
        featureSubsetStrategy=estimator.getFeatureSubsetStrategy(), maxDepth=estimator.getMaxDepth(), maxBins=estimator.getMaxBins(),
        minInstancesPerNode=estimator.getMinInstancesPerNode(), seed=seed,
    )


def constant_tree(train: DataFrame, label: str):
    """A tree of one leaf: the training mean."""
    return RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=1, bootstrap=False, maxDepth=0).fit(train)._java_obj.trees()[0]


class Stopper:
    """The best round so far, and whether patience is over: no loss in so many rounds was better by the share `gain`."""

    def __init__(self, patience: int, gain: float = 0.0) -> None:
        self.patience, self.gain, self.best, self.least, self.rounds = patience, gain, 0, float("inf"), 0
        self.mark, self.marked = float("inf"), 0

    def over(self, loss: float) -> bool:
        self.rounds += 1
        if loss < self.least:
            self.best, self.least = self.rounds, loss
        if loss < self.mark * (1 - self.gain):
            self.mark, self.marked = loss, self.rounds
        return self.rounds - self.marked >= self.patience


def fit_boosted(
    data: DataFrame, estimator: GBTRegressor, patience: int = PATIENCE, write_every: int = WRITE_EVERY, gain: float = 0.0,
) -> GBTRegressionModel:
    """Squared-loss boosting of (features, label, split) up to the best round on the validation rows.

    Without validation rows all rounds are fitted.
    """
    spark, label, step = data.sparkSession, estimator.getLabelCol(), estimator.getStepSize()
    rows = data.select("features", F.col(label).cast("double").alias("label"), (F.col("split") == "val").alias("held")).where(F.col("split").isin("train", "val"))
    rows = materialise(rows, "boosting")
    trees, weights = [constant_tree(rows.where(~F.col("held")), "label")], [1.0]
    held = rows.where("held")
    watched = not held.isEmpty()
    rows, since = rows.withColumn("score", F.lit(0.0)), 0
    stop = Stopper(patience, gain)

    def scored(df: DataFrame) -> DataFrame:
        """`residual` after all trees so far."""
        if len(trees) == since:
            return df.withColumns({"prediction": F.lit(0.0), "residual": F.col("label") - F.col("score")})
        added = ensemble(spark, trees[since:], weights[since:], "label").transform(df)
        return added.withColumn("residual", F.col("label") - F.col("score") - F.col("prediction"))

    for number in range(estimator.getMaxIter()):
        train = scored(rows.where(~F.col("held"))).select("features", "residual")
        trees.append(one_tree(estimator, estimator.getSeed() + number, "residual").fit(train)._java_obj.trees()[0])
        weights.append(step)
        if watched and stop.over(scored(rows.where("held")).agg(F.avg(F.col("residual") * F.col("residual"))).first()[0]):
            break
        if len(trees) - since >= write_every:
            rows = materialise(scored(rows).select("features", "label", "held", (F.col("score") + F.col("prediction")).alias("score")), "boosting")
            since = len(trees)
    if watched:
        trees, weights = trees[: stop.best + 1], weights[: stop.best + 1]
    return ensemble(spark, trees, weights, label)


class BoostedClasses:
    """Boosted class scores: a prior and a `GBTRegressionModel` per class; probabilities are the softmax of their sums."""

    def __init__(self, models: Sequence[GBTRegressionModel], priors: Sequence[float] | None = None) -> None:
        self.models, self.priors = list(models), list(priors or [0.0] * len(models))

    def scores(self, data: DataFrame, name: str = "scores") -> DataFrame:
        out = data
        for k, model in enumerate(self.models):
            out = model.setPredictionCol(f"_score_{k}").transform(out)
        own = [f"_score_{k}" for k in range(len(self.models))]
        return out.withColumn(name, F.array(*[F.col(c) + prior for c, prior in zip(own, self.priors)])).drop(*own)

    def transform(self, data: DataFrame) -> DataFrame:
        """`probability` (an array that sums to 1) and `prediction`, the likeliest class, of equal ones the first."""
        with_scores = self.scores(data, "_scores")
        probability = softmax(F.col("_scores"))
        return with_scores.withColumn("probability", probability).withColumn(
            "prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double")).drop("_scores")


def softmax(scores: Column) -> Column:
    powers = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))


def log_loss(probability: Column, label: Column) -> Column:
    return -F.log(F.greatest(F.element_at(probability, label + 1), F.lit(LEAST)))


def fit_boosted_classes(
    data: DataFrame, estimator: GBTRegressor, classes: int, patience: int = PATIENCE, write_every: int = WRITE_EVERY, workers: int = 4,
) -> BoostedClasses:
    """Softmax boosting of (features, integer label 0 .. classes - 1, split), stopped by the validation log loss.

    A round's trees, one per class, are fitted side by side over one stored table of residuals.
    """
    spark, label, step = data.sparkSession, estimator.getLabelCol(), estimator.getStepSize()
    rows = data.where(F.col("split").isin("train", "val") & F.col(label).isNotNull()).select(
        "features", F.col(label).cast("int").alias("label"), (F.col("split") == "val").alias("held"))
    rows = materialise(rows, "boosting")
    # one row per class; scores begin with the log of its share of the training rows, unchanged, or of `LEAST` if it has none there:
    # a share moved towards the others costs more on training rows than trees win back where a class is rare
    counts = {r.label: r["count"] for r in rows.where(~F.col("held")).groupBy("label").count().collect()}
    priors = [math.log(max(counts.get(k, 0) / max(1, sum(counts.values())), LEAST)) for k in range(classes)]
    rows = rows.withColumn("score", F.array(*[F.lit(x) for x in priors]))
    watched = not rows.where("held").isEmpty()
    trees: list[list] = [[] for _ in range(classes)]
    since, stop = 0, Stopper(patience)

    def scored(df: DataFrame) -> DataFrame:
        if len(trees[0]) == since:
            return df.withColumn("probability", softmax(F.col("score")))
        added = BoostedClasses([ensemble(spark, t[since:], [step] * (len(t) - since), "label") for t in trees]).scores(df, "_added")
        added = added.withColumn("score", F.zip_with("score", "_added", lambda a, b: a + b)).drop("_added")
        return added.withColumn("probability", softmax(F.col("score")))

    with ThreadPoolExecutor(workers) as pool:
        for number in range(estimator.getMaxIter()):
            wrong = [((F.col("label") == k).cast("double") - F.element_at("probability", k + 1)).alias(f"r{k}") for k in range(classes)]
            train = scored(rows.where(~F.col("held"))).select("features", *wrong)

            def fit(k: int, train: DataFrame = train, number: int = number):
                return one_tree(estimator, estimator.getSeed() + number * classes + k, f"r{k}").fit(train)._java_obj.trees()[0]

            for own, tree in zip(trees, pool.map(inheritable_thread_target(spark)(fit), range(classes))):
                own.append(tree)
            if watched and stop.over(scored(rows.where("held")).agg(F.avg(log_loss(F.col("probability"), F.col("label")))).first()[0]):
                break
            if len(trees[0]) - since >= write_every:
                rows = materialise(scored(rows).select("features", "label", "held", "score"), "boosting")
                since = len(trees[0])
    kept = stop.best if watched else len(trees[0])
    return BoostedClasses([ensemble(spark, t[:kept], [step] * kept, label) for t in trees], priors)


def leaves(model, data: DataFrame, name: str = "leaves") -> DataFrame:
    """`data` with the number of the leaf each tree of the model puts a row into."""
    return model.setLeafCol("_leaf").transform(data).withColumn(name, F.transform(vector_to_array("_leaf"), lambda x: x.cast("int"))).drop("_leaf")
