"""Extremely randomised trees: one random cut per feature and node, the best of them taken; no bootstrap.

All trees grow together, a level at a time, over one stored table that is never rewritten. A level takes two grouped
aggregations by (tree, node): the extent of each feature, then the sums left of the cuts drawn inside those extents. Both are
combined before the shuffle, so what moves is one row per task and open node, whatever the number of rows. Only chosen cuts
reach the driver; a forest has at most `trees * 2 ** (depth + 1)` nodes, and no more than rows / `min_leaf` leaves a tree.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourweave.session import materialise

NODES = "tree int, node int, feature int, cut double, below int, above int, value double, gain double"
LEAF, OPEN = -1, -2
MOST_DEPTH = 24


@dataclass
class Node:
    """A node of a tree: rows with `feature` <= `cut` go to node `below`, others to `above`; a leaf predicts `value`."""

    feature: int = OPEN
    cut: float = 0.0
    below: int = 0
    above: int = 0
    value: float = 0.0
    gain: float = 0.0


def draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its arguments, so a lost task draws the same again."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _forest(trees: Sequence[Sequence[Node]]) -> Column:
    """The forest as a constant: per tree an array of nodes, so that a step down is an array lookup and no row carries it."""
    nodes = [[{"feature": n.feature, "cut": n.cut, "below": n.below, "above": n.above, "value": n.value} for n in own] for own in trees]
    return F.from_json(F.lit(json.dumps(nodes)), "array<array<struct<feature:int,cut:double,below:int,above:int,value:double>>>")


def _places(features: Column, forest: Column, trees: int, steps: int) -> Column:
    """The node each tree puts a row into, `steps` levels down or at an earlier leaf."""
    def down(node: Column, tree: Column) -> Column:
        at = forest[tree][node]
        goes_below = features[F.greatest(at["feature"], F.lit(0))] <= at["cut"]
        return F.when(at["feature"] < 0, node).when(goes_below, at["below"]).otherwise(at["above"])

    start = F.array_repeat(F.lit(0), trees)
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda nodes, _: F.transform(nodes, down)) if steps else start


class ExtraTreesModel(Model, MLWritable, MLReadable):
    """A fitted forest; the prediction is the mean of the leaves' training means."""

    def __init__(self, trees: Sequence[Sequence[Node]], n_features: int, depth: int) -> None:
        super().__init__()
        self.trees, self.n_features, self.depth = [list(t) for t in trees], n_features, depth

    @property
    def featureImportances(self) -> DenseVector:
        """Gains per feature, each tree's shares summing to 1, averaged over trees with any cut."""
        total, grown = [0.0] * self.n_features, 0
        for nodes in self.trees:
            whole = math.fsum(n.gain for n in nodes)
            if whole > 0:
                grown += 1
                for n in nodes:
                    if n.feature >= 0:
                        total[n.feature] += n.gain / whole
        return Vectors.dense([x / max(grown, 1) for x in total])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = _forest(self.trees)
        placed = dataset.withColumn("_x", vector_to_array("features")).withColumn("_nodes", _places(F.col("_x"), forest, len(self.trees), self.depth))
        values = F.transform("_nodes", lambda node, tree: forest[tree][node]["value"])
        mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.lit(float(len(self.trees)))
        return placed.withColumn("prediction", mean).drop("_x", "_nodes")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ExtraTreesModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, model = self.sparkSession, self.model
        DefaultParamsWriter.saveMetadata(model, path, spark, {"n_features": model.n_features, "depth": model.depth})
        rows = [(t, i, *astuple(n)) for t, nodes in enumerate(model.trees) for i, n in enumerate(nodes)]
        spark.createDataFrame(rows, NODES).coalesce(1).write.parquet(f"{path}/nodes")


class _ForestReader(MLReader):
    def load(self, path: str) -> ExtraTreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees: list[list[Node]] = []
        # the forest, as large as when it was fitted
        for tree, _, *node in self.sparkSession.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            if tree == len(trees):
                trees.append([])
            trees[tree].append(Node(*node))
        model = ExtraTreesModel(trees, metadata["n_features"], metadata["depth"])
        model._resetUid(metadata["uid"])
        return model


class ExtraTrees(Estimator):
    """Estimator over (features, label); every row trains every tree.

    `share` of the features, "sqrt" or a number, are drawn per node without the ones constant there. A node is cut while it has
    `min_split` rows and some drawn cut leaves `min_leaf` rows on both sides; the cut taken lowers the squared error
    most, of equal ones that of the first feature. Rows with a null label do not train. Features must not be null.
    """

    def __init__(
        self, label: str, trees: int = 200, depth: int = 20, min_split: int = 100, min_leaf: int = 50, share: str | float = "sqrt", seed: int = 42,
    ) -> None:
        super().__init__()
        if not 0 <= depth <= MOST_DEPTH or trees < 1 or min_leaf < 1:
            raise ValueError(f"trees >= 1, min_leaf >= 1 and depth of 0 to {MOST_DEPTH} wanted")
        self.label, self.trees, self.depth, self.min_split, self.min_leaf, self.share, self.seed = label, trees, depth, min_split, min_leaf, share, seed

    def getLabelCol(self) -> str:
        return self.label

    def _fit(self, dataset: DataFrame) -> ExtraTreesModel:
        y = F.col(self.label).cast("double")
        rows = materialise(dataset.where(y.isNotNull()).select(vector_to_array("features").alias("x"), y.alias("y")), "extra-trees")
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.max(F.size("x")).alias("width")).first()
        if not size.n:
            raise ValueError("no rows with a label")
        # sums of distances to the mean: large offsets cost no digits
        rows = rows.withColumn("y", F.col("y") - F.lit(size.mean))
        forest = [[Node()] for _ in range(self.trees)]
        for level in range(self.depth + 1):
            if not any(n.feature == OPEN for nodes in forest for n in nodes):
                break
            for row in self._level(rows, forest, level, size.width):
                nodes = forest[row.tree]
                node = nodes[row.node]
                node.value = size.mean + row.mean
                if row.best is None:
                    node.feature = LEAF
                else:
                    node.feature, node.cut, node.gain = row.best.feature, row.best.cut, row.best.gain
                    node.below, node.above = len(nodes), len(nodes) + 1
                    nodes += [Node(), Node()]
        return ExtraTreesModel(forest, size.width, self.depth)

    def _level(self, rows: DataFrame, forest: list[list[Node]], level: int, width: int) -> list:
        """Rows (tree, node, mean, best) of all open nodes, in their order; `best` is null for a leaf."""
        shape = _forest(forest)
        places = _places(F.col("x"), shape, self.trees, level)
        still_open = F.transform(places, lambda node, tree: F.when(shape[tree][node]["feature"] == OPEN, node))
        spread_out = rows.select("x", "y", F.posexplode(still_open).alias("tree", "node")).where(F.col("node").isNotNull()).select(
            "tree", "node", "y", *[F.col("x")[i].alias(f"x{i}") for i in range(width)])
        each = range(width)
        listed = lambda name: F.array(*[F.col(f"{name}{i}") for i in each]).alias(name)
        extents = spread_out.groupBy("tree", "node").agg(
            F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), *[f(f"x{i}").alias(f"{name}{i}") for i in each for name, f in (("low", F.min), ("high", F.max))]
        ).select("tree", "node", "n", "s", listed("low"), listed("high"))
        if level == self.depth:
            return extents.select("tree", "node", (F.col("s") / F.col("n")).alias("mean"), F.lit(None).cast("string").alias("best")).orderBy("tree", "node").collect()
        grows = F.col("n") >= max(self.min_split, 2 * self.min_leaf)
        # one row per open node, stored: its size, not a guess, decides whether it is broadcast
        nodes = materialise(extents.select("tree", "node", "n", "s", F.when(grows, self._cuts(width)).alias("cuts")), "extra-trees-nodes")
        cut = nodes.where(F.col("cuts").isNotNull()).select(F.col("tree").alias("_t"), F.col("node").alias("_n"), *[F.col("cuts")[i].alias(f"c{i}") for i in each])
        inside = spread_out.join(cut, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
        # a feature that was not drawn has no cut, so nothing is below it
        below = [F.col(f"x{i}") <= F.col(f"c{i}") for i in each]
        sums = inside.groupBy("tree", "node").agg(
            *[c for i in each for c in (F.count(F.when(below[i], 1)).alias(f"left{i}"), F.sum(F.when(below[i], F.col("y"))).alias(f"sum{i}"))]
        ).select("tree", "node", listed("left"), listed("sum"))
        scored = nodes.join(sums, ["tree", "node"], "left").withColumn("best", self._best(width))
        return scored.select("tree", "node", (F.col("s") / F.col("n")).alias("mean"), "best").orderBy("tree", "node").collect()

    def _cuts(self, width: int) -> Column:
        """Per feature its cut, uniform inside the node's extent; null for features not drawn or constant."""
        wanted = max(1, int(math.sqrt(width)) if self.share == "sqrt" else round(float(self.share) * width))
        every = F.sequence(F.lit(0), F.lit(width - 1))
        own = lambda kind, i: draw(self.seed, F.lit(kind), F.col("tree"), F.col("node"), i)
        low, high = (lambda i: F.col("low")[i]), (lambda i: F.col("high")[i])
        order = F.array_sort(F.transform(F.filter(every, lambda i: low(i) < high(i)), lambda i: F.struct(own("order", i).alias("u"), i.alias("i"))))
        drawn = F.transform(F.slice(order, 1, wanted), lambda p: p["i"])
        cuts = F.map_from_arrays(drawn, F.transform(drawn, lambda i: low(i) + own("cut", i) * (high(i) - low(i))))
        return F.transform(every, lambda i: F.try_element_at(cuts, i))

    def _best(self, width: int) -> Column:
        """The cut of most gain (gain, feature, cut); null where none leaves enough rows or gains anything."""
        def candidate(i: Column) -> Column:
            n, s, left, sl = F.col("n"), F.col("s"), F.col("left")[i], F.col("sum")[i]
            right, sr = n - left, s - sl
            gain = sl * sl / F.nullif(left, F.lit(0)) + sr * sr / F.nullif(right, F.lit(0)) - s * s / n
            enough = (left >= self.min_leaf) & (right >= self.min_leaf) & (gain > 0)
            return F.when(enough, F.struct(gain.alias("gain"), (-i).alias("_first"), i.alias("feature"), F.col("cuts")[i].alias("cut")))

        return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), candidate))
