"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # plans here are built from many small expressions; call sites per expression cost more than they tell
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # read parquet timestamps without a zone as TIMESTAMP_NTZ
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(app_name: str = "hourweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; `conf` keys use `__` for `.` and win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in spark.checkpoint.dir.

    Where that is unset: a folder below the session's warehouse, which a cluster shares too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/hourweave-scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root, never used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage before iterative fits, survives lost executors, and gives the
    planner real file sizes, so it can choose broadcasts from facts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: dict[str, list[str]] = {}


def clear_materialised(spark: SparkSession) -> int:
    """Delete every folder `materialise` wrote in this application; returns how many.

    Tables read back from them cannot be read afterwards, so call it when the results are stored.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)
