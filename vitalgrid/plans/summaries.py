"""Exact per-series quantiles and modes without holding a large series in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.expressions import nan_to_null
from vitalgrid.plans.series import Series, attach, has_large_series


def _per_column(columns: list[str], value: Column) -> list[Column]:
    """Turn (…, _col, value) rows back into one column per name."""
    return [F.max(F.when(F.col("_col") == c, value)).alias(c) for c in columns]


def quantiles(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    probs: list[float],
    approx: bool = False,
    sliced: bool | None = None,
) -> DataFrame:
    """One row per series; each column holds the array of its quantiles (linear interpolation).

    Series that fit one task use the built-in exact aggregate. Larger ones are counted per
    distinct value first, the distinct values are ranked across tasks, and only the values at
    the wanted ranks are kept. ``approx`` uses mergeable sketches instead. Nulls and NaN don't
    count; a series without any value has a null in place of the array.
    """
    df = nan_to_null(df.select(*dict.fromkeys([*keys, *columns])))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if approx:
        return df.groupBy(*keys).agg(*[F.percentile_approx(c, wanted, 10000).alias(c) for c in columns])
    if sliced is None:
        sliced = has_large_series(df, keys, len(columns))
    if not sliced:
        return df.groupBy(*keys).agg(*[F.percentile(c, wanted).alias(c) for c in columns])

    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    long = long.unpivot(keys, columns, "_col", "_v")
    counted = long.filter("_v is not null").groupBy(*keys, "_col", "_v").agg(F.count("*").alias("_w"))
    totals = counted.groupBy(*keys, "_col").agg(F.sum("_w").alias("_n"))
    ranked = Series.of(counted, [*keys, "_col"], ["_v"], sliced=True).running_total("_upto", F.col("_w")).done()

    ranked = attach(ranked, totals, [*keys, "_col"])
    picks = []
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("_n") - 1)
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            inside = (at >= F.col("_upto") - F.col("_w")) & (at < F.col("_upto"))
            picks.append(F.max(F.when(inside, F.col("_v"))).alias(f"_{side}{i}"))
    found = ranked.groupBy(*keys, "_col").agg(F.max("_n").alias("_n"), *picks)
    values = []
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("_n") - 1)
        part = rank - F.floor(rank)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        values.append(F.when((part == 0) | (low == high), low).otherwise(low * (1 - part) + high * part))
    found = found.withColumn("_q", F.array(*values))
    found = found.groupBy(*keys).agg(*_per_column(columns, F.col("_q")))
    if not keys:
        return found
    return attach(df.groupBy(*keys).agg(F.count("*").alias("_n")).drop("_n"), found, keys)


def mode_of(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per series with the most frequent value of ``column``, the smallest one on a tie.

    Counting per (series, value) comes first, so no task holds all values of a series.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v")))
    return counted.groupBy(*keys).agg(best["v"].alias(column))


def with_quantiles(series: Series, columns: list[str], probs: list[float], prefix: str, approx: bool = False) -> Series:
    """Add the quantile array of each column, over the whole series, to its rows."""
    if not columns:
        return series
    if not series.sliced and not approx:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        return series.stats({f"{prefix}{c}": F.percentile(c, wanted) for c in columns})
    found = quantiles(series.df, series.keys, columns, probs, approx, series.sliced)
    renamed = found.select(*series.keys, *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return series.on(attach(series.df, renamed, series.keys))


def with_mode(series: Series, column: str, name: str) -> Series:
    """Add the most frequent value of ``column`` in the series to its rows."""
    if not series.sliced:
        return series.stats({name: F.mode(column, True)})
    best = mode_of(series.df, series.keys, column).withColumnRenamed(column, name)
    return series.on(attach(series.df, best, series.keys))
