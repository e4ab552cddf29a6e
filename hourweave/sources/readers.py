"""Where feeds come from: parquet folders, JDBC tables, JSON requests, or nowhere."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourweave.functions.scalar import nan_to_null
from hourweave.sources.schemas import FEEDS


def read_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    recursive: bool = False,
    pattern: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Parquet with NaN read as NULL. `recursive` and `pattern` find files below several roots.

    `where` is a condition on values (no null tests). It is applied to the stored columns, so
    it reaches the file scan also for doubles, and again after NaN became NULL.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    stored = reader.parquet(*([path] if isinstance(path, str) else path))
    return nan_to_null(stored) if where is None else nan_to_null(stored.filter(where)).filter(where)


@dataclass(frozen=True)
class JdbcPartitioning:
    """How a table read is spread over executors: numeric or time column and its rough range."""

    column: str
    lower: str
    upper: str
    partitions: int = 32


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partitioning: JdbcPartitioning | None = None,
    fetch_size: int = 100_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, fetched in parallel ranges; filters and columns are pushed to the database."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, fetchsize=str(fetch_size), preferTimestampNTZ="true", **dict(properties or {})
    )
    if partitioning is not None:
        reader = reader.options(
            partitionColumn=partitioning.column,
            lowerBound=partitioning.lower,
            upperBound=partitioning.upper,
            numPartitions=str(partitioning.partitions),
        )
    return nan_to_null(reader.load())


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The feed if it exists, else no rows of the declared shape."""
    try:
        return read_parquet(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


#: Roles whose named feed may not be there yet.
OPTIONAL = frozenset({"rtm_alt"})


@dataclass(frozen=True)
class Market:
    """One market's feeds: role -> parquet path, catalog table, or a function that gives a DataFrame.

    A market may do without a role. A feed that it names must exist, unless its role is in `OPTIONAL`.
    """

    name: str
    feeds: Mapping[str, str | Callable[[], DataFrame]] = field(default_factory=dict)

    def read(self, spark: SparkSession, role: str) -> DataFrame:
        """The feed in `role`; a role without a feed is empty."""
        schema = FEEDS[role]
        feed = self.feeds.get(role)
        if feed is None:
            return empty(spark, schema)
        if callable(feed):
            return nan_to_null(feed())
        if role not in OPTIONAL:
            return read_parquet(spark, feed) if "/" in feed else nan_to_null(spark.table(feed))
        if "/" in feed:
            return read_optional(spark, feed, schema)
        return nan_to_null(spark.table(feed)) if spark.catalog.tableExists(feed) else empty(spark, schema)


class Markets:
    """Registry, so one job runs for any market by name."""

    def __init__(self, markets: Sequence[Market] = ()):
        self._by_name = {m.name: m for m in markets}

    def register(self, market: Market) -> None:
        self._by_name[market.name] = market

    def __getitem__(self, name: str) -> Market:
        if name not in self._by_name:
            raise KeyError(f"unknown market {name}; have {', '.join(sorted(self._by_name))}")
        return self._by_name[name]


def request_schema(features: Sequence[str]) -> T.StructType:
    """Shape of a scoring request: {"data": [{TimestampHour, SettlementPoint, features...}]}."""
    row = T.StructType(
        [T.StructField("TimestampHour", T.StringType()), T.StructField("SettlementPoint", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in features]
    )
    return T.StructType([T.StructField("data", T.ArrayType(row))])


def request_rows(requests: DataFrame, features: Sequence[str], column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of JSON requests; fields a request lacks are null."""
    parsed = requests.select(*keep, F.from_json(column, request_schema(features)).alias("r"))
    return parsed.select(*keep, F.inline("r.data")).withColumn(
        "TimestampHour", F.col("TimestampHour").try_cast("timestamp_ntz")
    )


def json_number(column: str, field_name: str) -> Column:
    """One numeric field of a flat JSON object column."""
    return F.from_json(column, T.StructType([T.StructField(field_name, T.DoubleType())]))[field_name]
