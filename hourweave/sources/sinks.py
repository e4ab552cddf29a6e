"""Where results go. All writes are parallel and can be repeated safely unless stated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.functions.timeutil import HOUR, KEY

PARTITIONS = ("year", "month", "day", "hour")


def write_ordered(df: DataFrame, path: str, order: Sequence[str] = (HOUR, KEY)) -> None:
    """Snappy parquet in hour order across and within files, by range partitioning.

    The key takes part in the ranges, so an hour with many rows is split over files.
    """
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(path)
    )


def with_partitions(df: DataFrame, ts: str = HOUR) -> DataFrame:
    """Add year, month, day and hour of the row."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)})


def prediction_rows(df: DataFrame, prediction: str = "prediction", model_type: str = "gbt") -> DataFrame:
    """The published shape; a frame without entities is published as SYSTEM."""
    key = F.coalesce(F.col(KEY).cast("string"), F.lit("SYSTEM")) if KEY in df.columns else F.lit("SYSTEM")
    kind = F.coalesce("ModelType", F.lit(model_type)) if "ModelType" in df.columns else F.lit(model_type)
    return df.select(
        F.col(HOUR), key.alias(KEY), F.col(prediction).cast("double").alias("DART_Prediction"), kind.alias("ModelType")
    )


def publish_partitions(df: DataFrame, path: str, ts: str = HOUR) -> None:
    """Parquet in year/month/day/hour folders; only the hours present in `df` are replaced.

    Rows are routed to their hour before the write, salted by key, so files stay few and
    an hour with many rows is not written by one task.
    """
    parts = with_partitions(df, ts)
    salt = F.pmod(F.hash(KEY), F.lit(8)) if KEY in df.columns else F.lit(0)
    (
        parts.withColumn("_salt", salt)
        .repartition(*PARTITIONS, "_salt")
        .drop("_salt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table, created on first use. Appending twice stores rows twice."""
    stamped = df.withColumn("PredictionTimestamp", F.current_timestamp())
    stamped.write.mode("append").saveAsTable(table)


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10_000, properties: Mapping[str, str] | None = None) -> None:
    """Append to a database table in batches, one connection per partition."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **dict(properties or {})).mode(
        "append"
    ).save()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def save_fitted(path: str, params: Mapping[str, DataFrame], model: PipelineModel | None = None) -> None:
    """Parameter tables as parquet and the pipeline next to them."""
    for name, table in params.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    if model is not None:
        model.write().overwrite().save(f"{path}/model")


def load_params(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
