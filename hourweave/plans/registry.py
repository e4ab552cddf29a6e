"""Named queries with the SQL that states their expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourweave.plans.bindings import Tables
from hourweave.plans.oracle import with_views

Build = Callable[[Tables], DataFrame]

_QUERIES: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Integers as BIGINT and doubles to six decimals, so two engines can be compared."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = build
        if sql is not None:
            _SQL[name] = with_views(sql)
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, build=build: comparable(build(Tables(spark, sf_dir))))
        for name, build in _QUERIES.items()
    }


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
