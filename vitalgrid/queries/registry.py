from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Test tables by name: ``t.events`` reads the whole table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def tidy(df: DataFrame) -> DataFrame:
    """Types that compare across engines: whole numbers as bigint, doubles to 6 decimals."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(build(Tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def R(expression: str) -> str:
    """SQL text of a double column as ``tidy`` shows it."""
    return f"round(({expression})::double, 6) + 0.0::double"
