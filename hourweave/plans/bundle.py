"""Fitted state under one version: model, columns, encodings, scaling and metrics, published together.

A bundle's parts are written to a folder of their own; then one row in the manifest names it. Readers start from the manifest,
so a save that breaks off is never seen, and a version that is saved again gives new readers its newest parts while
earlier ones keep theirs.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators.prep import Roles
from hourweave.plans.dataset import Fitted
from hourweave.sources.sinks import prediction_rows

MANIFEST = "version string, kind string, folder string, saved_micros long"
_COLUMNS = "place int, name string, role string"


@dataclass(frozen=True)
class Bundle:
    """A loaded version; `metrics` is the table that was saved with it."""

    version: str
    kind: str
    model: PipelineModel
    fitted: Fitted
    metrics: DataFrame

    def score(self, rows: DataFrame) -> DataFrame:
        """Published prediction rows for any frame with the hour and the key; absent features are 0.0."""
        kept = rows.withColumn("entity", F.col(KEY))
        ready = self.fitted.score_input(kept, keep=(HOUR, "entity")).withColumnsRenamed({KEY: "encoded", "entity": KEY})
        return prediction_rows(self.model.transform(ready), model_type=self.kind)


def save_bundle(root: str, version: str, model: PipelineModel, fitted: Fitted, metrics: DataFrame, kind: str = "gbt") -> str:
    """Write all parts, then publish them; returns the folder."""
    spark = metrics.sparkSession
    folder = f"{root.rstrip('/')}/parts/{version}-{uuid.uuid4().hex}"
    model.write().save(f"{folder}/model")
    fitted.encodings.write.parquet(f"{folder}/encodings")
    fitted.scaling.write.parquet(f"{folder}/scaling")
    metrics.write.parquet(f"{folder}/metrics")
    named = [(c, "categorical") for c in fitted.roles.categorical] + [(c, "continuous") for c in fitted.roles.continuous]
    # one row per feature
    spark.createDataFrame([(i, *x) for i, x in enumerate(named)], _COLUMNS).write.parquet(f"{folder}/columns")
    spark.createDataFrame([(version, kind, folder, time.time_ns() // 1000)], MANIFEST).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return folder


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The manifest: `version, kind, folder, saved_micros`; no rows where nothing was published."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def load_bundle(spark: SparkSession, root: str, version: str | None = None) -> Bundle:
    """The newest save of `version`, or of all."""
    known = versions(spark, root)
    if version is not None:
        known = known.where(F.col("version") == version)
    row = known.orderBy(F.desc("saved_micros"), F.desc("folder")).first()
    if row is None:
        raise LookupError(f"no bundle {version or ''} below {root}")
    # one row per feature
    columns = spark.read.schema(_COLUMNS).parquet(f"{row.folder}/columns").orderBy("place").collect()
    roles = Roles(*(tuple(c.name for c in columns if c.role == role) for role in ("categorical", "continuous")))
    fitted = Fitted(roles, spark.read.parquet(f"{row.folder}/encodings"), spark.read.parquet(f"{row.folder}/scaling"))
    return Bundle(row.version, row.kind, PipelineModel.load(f"{row.folder}/model"), fitted, spark.read.parquet(f"{row.folder}/metrics"))
