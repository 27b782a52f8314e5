"""Names, timestamps and calendar columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import COLUMN_NAMES, METRIC_COLUMN, SCHEMAS, TIMESTAMP_NAMES
from vitalgrid.functions.expressions import NUMERIC, numeric_columns


def snake(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def standard_name(name: str) -> str:
    return COLUMN_NAMES.get(snake(name), snake(name))


def standardize_columns(df: DataFrame, map_first: bool = False) -> DataFrame:
    """Standard column names. Lower-casing comes before the name map, or after it with
    ``map_first`` (then ``HR`` only becomes ``hr``, and ``pulse`` is not known)."""
    if map_first:
        known = {k: v for k, v in COLUMN_NAMES.items() if k != "pulse"}
        names = [snake(known.get(c, c)) for c in df.columns]
    else:
        names = [standard_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns would be named {', '.join(twice)}")
    return df.toDF(*names)


def missing_columns(columns: list[str], data_type: str) -> list[str]:
    """Required columns that no column matches, not even as a part of its name."""
    if data_type not in SCHEMAS:
        return []
    have = [snake(c.strip()) for c in columns]
    return [r for r in SCHEMAS[data_type]["required"] if not any(r in c or c in r for c in have)]


def has_schema(df: DataFrame, data_type: str) -> bool:
    return not missing_columns(df.columns, data_type)


def detect_timestamp_column(df: DataFrame) -> str:
    """By name, then by name without case, then the first column whose leading rows parse."""
    for name in TIMESTAMP_NAMES:
        if name in df.columns:
            return name
    lowered = {n.lower() for n in TIMESTAMP_NAMES}
    for name in df.columns:
        if name.lower() in lowered:
            return name
    candidates = [f.name for f in df.schema.fields if not isinstance(f.dataType, (*NUMERIC, T.BooleanType))]
    candidates = [c for c in candidates if isinstance(df.schema[c].dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    if candidates:
        bad = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("timestamp").isNull()).alias(c) for c in candidates]
        seen = df.select(*candidates).limit(10).agg(*bad).first()
        for name in candidates:
            if seen[name] == 0:
                return name
    raise ValueError("no timestamp column found")


def parse_timestamp(c: Column) -> Column:
    """Text to an instant, null where it does not parse; text without a zone counts as UTC."""
    return c.try_cast("timestamp")


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    t = F.col(ts)
    return df.withColumns(
        {
            "hour_of_day": F.hour(t),
            "day_of_week": F.date_format(t, "EEEE"),
            "date": F.to_date(t),
            "is_weekend": F.weekday(t).isin(5, 6),
        }
    )


def add_hours(df: DataFrame, minutes: str = "duration_minutes", name: str = "duration_hours") -> DataFrame:
    return df.withColumn(name, F.col(minutes) / 60)


def metric_values(df: DataFrame, data_type: str, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """(keys, ts, value) of a data type; an unknown type or a missing column gives no rows."""
    column = METRIC_COLUMN.get(data_type)
    if column is None or column not in df.columns:
        return df.select(*keys, F.col(ts), F.lit(None).cast("double").alias("value")).filter(F.lit(False))
    return df.select(*keys, F.col(ts), F.col(column).cast("double").alias("value"))


def metric_values_by_type(df: DataFrame, type_column: str, keys: list[str], ts: str) -> DataFrame:
    """The same for a table that mixes data types row by row: the row's own metric column."""
    pick = F.lit(None).cast("double")
    for data_type, column in METRIC_COLUMN.items():
        if column in df.columns:
            pick = F.when(F.col(type_column) == data_type, F.col(column).cast("double")).otherwise(pick)
    return df.select(*keys, type_column, ts, pick.alias("value")).filter(F.col(type_column).isin(*METRIC_COLUMN))


def to_long(df: DataFrame, keys: list[str], ts: str, columns: list[str] | None = None) -> DataFrame:
    """One row per (keys, ts, metric) from a table with one column per metric."""
    columns = columns or numeric_columns(df, exclude=keys)
    wide = df.select(*keys, ts, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([*keys, ts], columns, "metric", "value")


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs become columns with dotted names; arrays are kept whole."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            at = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, at)
            else:
                yield at

    def reference(path: tuple[str, ...]) -> Column:
        return F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path))

    return df.select(*[reference(p) for p in leaves(df.schema, ())])


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])
