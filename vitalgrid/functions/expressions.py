"""Column expressions shared by the operators; all of them stay inside generated code."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import ANOMALY_SUFFIX, OUTLIER_SUFFIX

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns, flags such as ``x_is_outlier`` and ``x_anomaly`` left out."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NUMERIC)
        and f.name not in exclude
        and not f.name.endswith((OUTLIER_SUFFIX, ANOMALY_SUFFIX))
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null, so comparisons and aggregates treat it as missing."""
    floating = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floating) if floating else df


def nan_is_missing(operator):
    """An operator whose first argument is a table: NaN in it counts as null."""

    @wraps(operator)
    def run(df: DataFrame, *args, **options):
        return operator(nan_to_null(df), *args, **options)

    return run


def half_even(pattern: str, decimals: int, *numbers: Column) -> Column:
    """Formatted text whose numbers are rounded half to even first, as decimal text shows them."""
    return F.format_string(pattern, *[F.bround(n.cast("double"), decimals) for n in numbers])


def micros(ts) -> Column:
    """Microseconds since 1970 of a timestamp, zoned or not (session time zone UTC)."""
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def from_micros(us: Column, like: T.DataType) -> Column:
    """The timestamp at ``us`` microseconds, in the type of the column it came from."""
    return F.timestamp_micros(us).cast(like)


def bin_start(us: Column, seconds: int) -> Column:
    width = seconds * 1_000_000
    return us - F.pmod(us, F.lit(width))


def clip(c: Column, low, high) -> Column:
    """Nulls stay null (``least``/``greatest`` would skip them)."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def share(part: Column, whole: Column) -> Column:
    """part / whole, null on an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def any_of(columns) -> Column:
    """True when any of the boolean columns is true; nulls count as false."""
    result = F.lit(False)
    for name in columns:
        result = result | F.coalesce(F.col(name), F.lit(False))
    return result


def title(c: Column) -> Column:
    return F.initcap(F.regexp_replace(c, "_", " "))
