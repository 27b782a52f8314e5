"""Timestamp and range checks, row filters, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.catalog import EARLIEST, VALUE_RANGES
from vitalgrid.functions.expressions import clip, nan_is_missing, share
from vitalgrid.plans.series import Series, attach


def as_moment(value) -> Column:
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp")


def timestamp_checks(ts: str, as_of=None) -> dict[str, Column]:
    """Per-row tests: unparsed, after ``as_of`` (default: now), before the first accepted moment."""
    t = F.col(ts).try_cast("timestamp")
    return {
        "invalid": t.isNull(),
        "future": F.coalesce(t > as_moment(as_of), F.lit(False)),
        "old": F.coalesce(t < as_moment(EARLIEST), F.lit(False)),
    }


def timestamp_report(df: DataFrame, keys: list[str], ts: str, as_of=None) -> DataFrame:
    checks = timestamp_checks(ts, as_of)
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        *[F.count_if(c).alias(f"{n}_timestamps") for n, c in checks.items()],
    ).withColumn("invalid_percentage", F.bround(100 * share(F.col("invalid_timestamps"), F.col("rows")), 1))


def drop_bad_timestamps(df: DataFrame, ts: str, as_of=None, keep_null: bool = False) -> DataFrame:
    """Rows dated in the future or before 2010 go; rows without a time go unless ``keep_null``."""
    checks = timestamp_checks(ts, as_of)
    bad = checks["future"] | checks["old"]
    return df.filter(~bad if keep_null else ~(bad | checks["invalid"]))


def out_of_range(column: str, ranges: dict | None = None) -> Column:
    low, high = (ranges or VALUE_RANGES)[column][:2]
    c = F.col(column)
    return F.coalesce((c < low) | ((c > high) & ~F.isnan(c.cast("double"))), F.lit(False))


@nan_is_missing
def clip_ranges(df: DataFrame, ranges: dict | None = None) -> DataFrame:
    """Values beyond the accepted range move to its nearest end; nulls stay null, NaN becomes null."""
    ranges = ranges or VALUE_RANGES
    present = [c for c in ranges if c in df.columns]
    types = {c: df.schema[c].dataType for c in present}
    return df.withColumns({c: clip(F.col(c), *ranges[c][:2]).cast(types[c]) for c in present}) if present else df


@nan_is_missing
def with_enough_rows(df: DataFrame, keys: list[str], at_least: int, value: str | None = None) -> DataFrame:
    """Rows of the series that have at least ``at_least`` rows (with a value, when given)."""
    kept = df.filter(F.col(value).isNotNull()) if value else df
    return attach(kept, kept.groupBy(*keys).agg(F.count("*").alias("_n")), keys).filter(F.col("_n") >= at_least).drop("_n")


def drop_duplicate_times(df: DataFrame, keys: list[str], ts: str, order: list[str]) -> DataFrame:
    """The first row per (series, time) in ``order``. An aggregate, so copies of one moment are
    merged before the shuffle however many there are."""
    rest = [c for c in df.columns if c not in (*keys, ts)]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys, ts).agg(first.alias("_row")).select(*keys, ts, "_row.*").select(*df.columns)


def keep_first_times(series: Series, ts: str) -> Series:
    """The same for ordered rows: a row stays when the row before has another time."""
    if series.order[0] != ts:
        kept = drop_duplicate_times(series.done(), series.keys, ts, series.order)
        return Series.of(kept, series.keys, series.order, series.sliced)
    series = series.neighbours(previous={"_before": F.col(ts)})
    return series.filter(F.col("_before").isNull() | (F.col("_before") != F.col(ts))).drop("_before")


def duplicate_time_report(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    per_time = df.groupBy(*keys, ts).count()
    return per_time.groupBy(*keys).agg(
        F.sum("count").alias("rows"), F.sum(F.col("count") - 1).alias("duplicates_removed")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: total rows, and full-row copies beyond the first (nulls equal nulls)."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_copies")).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def distinct_counts(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """One row: distinct non-null values per column."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns or df.columns])
