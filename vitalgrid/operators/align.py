"""Resampling to a uniform time grid, gap detection, series extent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import FREQUENCIES, NO_ROWS_LEFT, OUTLIER_SUFFIX
from vitalgrid.functions.expressions import NUMERIC, from_micros, half_even, micros, numeric_columns
from vitalgrid.operators.missing import fill_gaps
from vitalgrid.plans.series import Series, attach, has_large_series
from vitalgrid.plans.summaries import mode_of, quantiles, with_quantiles

DAY = 86_400
GRID_CHUNK = 4096


def with_gaps(series: Series, ts: str) -> Series:
    """Add ``gap_seconds``: time since the row before in the same series."""
    series = series.neighbours(previous={"_before": micros(ts)})
    gap = (micros(ts) - F.col("_before")) / F.lit(1e6)
    return series.with_columns({"gap_seconds": gap}).drop("_before")


def frequency_name(seconds: Column, rows: Column) -> Column:
    return (
        F.when(rows < 2, F.lit("insufficient_data"))
        .when(seconds < 60, F.format_string("%dsec", seconds.cast("long")))
        .when(seconds < 3600, F.format_string("%dmin", (seconds / 60).cast("long")))
        .otherwise(half_even("%.1fhour", 1, seconds / 3600))
    )


def series_steps(df: DataFrame, keys: list[str], ts: str, order=None, sliced: bool | None = None) -> DataFrame:
    """One row per series: rows, first and last time, median step."""
    if sliced is None:
        sliced = has_large_series(df, keys)
    narrow = df.select(*dict.fromkeys([*keys, ts, *(order or [])]))
    gaps = with_gaps(Series.of(narrow, keys, order or [ts], sliced), ts).done()
    facts = [F.count("*").alias("rows"), F.min(ts).alias("first"), F.max(ts).alias("last")]
    if not sliced:
        median = F.percentile("gap_seconds", F.lit(0.5)).alias("median_seconds")
        return gaps.groupBy(*keys).agg(*facts, median)
    median = quantiles(gaps, keys, ["gap_seconds"], [0.5], sliced=True)
    median = median.select(*keys, F.col("gap_seconds")[0].alias("median_seconds"))
    return attach(gaps.groupBy(*keys).agg(*facts), median, keys)


def detect_frequency(df: DataFrame, keys: list[str], ts: str, order=None, sliced: bool | None = None) -> DataFrame:
    """One row per series: rows, median step in seconds and its name."""
    steps = series_steps(df, keys, ts, order, sliced)
    name = frequency_name(F.col("median_seconds"), F.col("rows"))
    return steps.select(*keys, "rows", "median_seconds", name.alias("frequency"))


def frequency_minutes(name: Column) -> Column:
    """Minutes of a frequency name by its first digits (``1.5hour`` counts 60); null if unknown."""
    n = F.lower(F.trim(name))
    digits = F.regexp_extract(n, r"(\d+)", 1).try_cast("double")
    return F.when(n.contains("min"), digits).when(n.contains("sec"), digits / 60).when(n.contains("hour"), digits * 60)


def _growth(seconds: int) -> dict[str, Column]:
    """Frequency, rows to expect, and whether to resample, from the columns of ``series_steps``."""
    minutes = (micros("last") - micros("first")) / F.lit(60e6)
    expected = minutes / F.lit(seconds / 60)
    name = frequency_name(F.col("median_seconds"), F.col("rows"))
    grows = frequency_minutes(name).isNotNull() & (expected > F.col("rows") * 5)
    return {"frequency": name, "expected_rows": expected, "resample": ~F.coalesce(grows, F.lit(False))}


def expansion_guard(df: DataFrame, keys: list[str], ts: str, seconds: int, order=None, sliced=None) -> DataFrame:
    """One row per series: its frequency, time span, and whether resampling to ``seconds`` would
    make more than five times the rows (``resample`` false)."""
    steps = series_steps(df, keys, ts, order, sliced).withColumns(_growth(seconds))
    return steps.select(*keys, "rows", "median_seconds", "frequency", "first", "last", "expected_rows", "resample")


def with_guard(series: Series, ts: str, seconds: int) -> Series:
    """The same test as a column ``resample`` on the rows."""
    series = with_quantiles(with_gaps(series, ts), ["gap_seconds"], [0.5], "_gap_")
    series = series.stats({"rows": F.count("*"), "first": F.min(ts), "last": F.max(ts)})
    series = series.with_columns({"median_seconds": F.col("_gap_gap_seconds")[0]})
    series = series.with_columns({"resample": _growth(seconds)["resample"]})
    return series.drop("gap_seconds", "_gap_gap_seconds", "median_seconds", "rows", "first", "last")


def to_bins(df: DataFrame, keys: list[str], ts: str, seconds: int, name: str = "_bin") -> DataFrame:
    """Add the start of each row's bin in microseconds. Bins count from midnight of the first day
    of the series, which for widths that divide a day is the same for every series."""
    width = seconds * 1_000_000
    us = micros(ts)
    if DAY % seconds == 0:
        return df.withColumn(name, us - F.pmod(us, F.lit(width)))
    first = df.groupBy(*keys).agg(F.min(us).alias("_first"))
    day = F.lit(DAY * 1_000_000)
    origin = F.col("_first") - F.pmod(F.col("_first"), day)
    binned = attach(df, first, keys).withColumn("_us", us)
    return binned.withColumn(name, F.col("_us") - F.pmod(F.col("_us") - origin, F.lit(width))).drop("_us", "_first")


def resample(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seconds: int,
    how: dict[str, str],
    order: list[str] | None = None,
    complete: bool = True,
    sliced: bool | None = None,
) -> DataFrame:
    """Aggregate each series into bins of ``seconds``; ``how`` names the aggregate per column:
    mean, sum, median, min, max, first, last or mode (another name means mean). With ``complete``
    every bin between the first and the last exists: sums are 0 there, the rest is null."""
    like = df.schema[ts].dataType
    how = {c: h if h in _AGGREGATES or h in ("median", "mode") else "mean" for c, h in how.items()}
    by = F.struct(*(order or [ts]))
    binned = to_bins(df.filter(F.col(ts).isNotNull()), keys, ts, seconds)
    group = [*keys, "_bin"]
    simple = [_AGGREGATES[h](c, by).alias(c) for c, h in how.items() if h in _AGGREGATES]
    result = binned.groupBy(*group).agg(*(simple or [F.count("*").alias("_n")]))
    medians = [c for c, h in how.items() if h == "median"]
    if medians:
        found = quantiles(binned, group, medians, [0.5])
        result = attach(result, found.select(*group, *[F.col(c)[0].alias(c) for c in medians]), group)
    for c in (c for c, h in how.items() if h == "mode"):
        result = attach(result, mode_of(binned, group, c), group)
    result = result.select(*group, *how)
    if complete:
        result = complete_grid(result, keys, seconds, zero=[c for c, h in how.items() if h == "sum"], sliced=sliced)
    return result.select(*keys, from_micros(F.col("_bin"), like).alias(ts), *how)


def _known(c, by):
    return F.when(F.col(c).isNotNull(), by)


_AGGREGATES = {
    "mean": lambda c, by: F.avg(c),
    "sum": lambda c, by: F.coalesce(F.sum(c), F.lit(0)),
    "min": lambda c, by: F.min(c),
    "max": lambda c, by: F.max(c),
    "first": lambda c, by: F.min_by(F.col(c), _known(c, by)),
    "last": lambda c, by: F.max_by(F.col(c), _known(c, by)),
}


def complete_grid(binned: DataFrame, keys: list[str], seconds: int, zero: list[str], sliced=None) -> DataFrame:
    """Add the empty bins: every bin row also emits the bins up to the next one. No join with a
    generated calendar, and the exchange on the keys serves the fills that follow."""
    width = F.lit(seconds * 1_000_000).cast("long")
    series = Series.of(binned, keys, ["_bin"], sliced).neighbours(following={"_next": F.col("_bin")})
    last = F.coalesce(F.col("_next") - width, F.col("_bin"))
    block = F.lit(seconds * 1_000_000 * GRID_CHUNK).cast("long")
    spread = series.done().withColumn("_last", last)
    spread = spread.withColumn("_from", F.explode(F.sequence("_bin", "_last", block)))
    upto = F.least(F.col("_from") + block - width, F.col("_last"))
    spread = spread.withColumn("_at", F.explode(F.sequence("_from", upto, width)))
    own = F.col("_at") == F.col("_bin")
    values = {
        c: F.when(own, F.col(c)).otherwise(F.lit(0).cast(binned.schema[c].dataType)) if c in zero else F.when(own, F.col(c))
        for c in binned.columns
        if c not in keys and c != "_bin"
    }
    return spread.select(*keys, F.col("_at").alias("_bin"), *[e.alias(c) for c, e in values.items()])


def smart_rules(df: DataFrame, keys: list[str], ts: str, order: list[str] = ()) -> dict[str, str]:
    """The aggregate that suits each column."""
    rules = {}
    for f in df.schema.fields:
        if f.name in keys or f.name == ts or f.name in order:
            continue
        if f.name.endswith(OUTLIER_SUFFIX):
            rules[f.name] = "max"
        elif f.name in ("step_count", "duration_minutes"):
            rules[f.name] = "sum"
        elif f.name == "sleep_stage":
            rules[f.name] = "mode"
        elif isinstance(f.dataType, NUMERIC):
            rules[f.name] = "mean"
        else:
            rules[f.name] = "first"
    return rules


def smart_resample(df, keys, ts, seconds, order=None, complete=True, sliced=None) -> DataFrame:
    return resample(df, keys, ts, seconds, smart_rules(df, keys, ts, order or []), order, complete, sliced)


def series_extent(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    extent = df.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(ts).alias("start"), F.max(ts).alias("end"))
    seconds = (micros("end") - micros("start")) / F.lit(1e6)
    return extent.withColumns({"span_hours": seconds / 3600, "span_days": F.floor(seconds / DAY)})


def align(
    df: DataFrame,
    keys: list[str],
    data_type: str,
    ts: str = "timestamp",
    target: str = "1 min",
    fill: str = "interpolate",
    order: list[str] | None = None,
    sliced: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Bring every series of a data type to the target frequency and fill the gaps. Daily sleep
    data and series that would grow more than five times keep their rows. Returns the rows and a
    report per series. A target that is no known frequency, or a table without its time column, leaves
    the rows as they are; the report has ``success`` false and says why."""
    error = align_error(df, data_type, ts, target)
    if error:
        return df, failed_report(df, keys, data_type, target, error)
    if sliced is None and data_type != "sleep":
        sliced = has_large_series(df, keys)
    aligned = align_rows(df, keys, data_type, ts, target, fill, order, sliced)
    return aligned, align_report(df, aligned, keys, data_type, ts, target, order, sliced)


def align_error(df: DataFrame, data_type: str, ts: str, target: str) -> str | None:
    """Why rows cannot be aligned; daily sleep data needs neither."""
    if data_type == "sleep":
        return None
    if ts not in df.columns:
        return f"None of ['{ts}'] are in the columns"
    return None if target in FREQUENCIES else f"'{target}'"


def failed_report(df: DataFrame, keys: list[str], data_type: str, target: str, error: str) -> DataFrame:
    rows = df.groupBy(*keys).agg(F.count("*").alias("original_rows"))
    return rows.select(
        *keys,
        F.lit(data_type).alias("data_type"),
        "original_rows",
        F.lit("unknown").alias("original_frequency"),
        F.lit(target).alias("target_frequency"),
        F.lit(None).cast("long").alias("resampled_rows"),
        F.lit(None).cast("double").alias("span_hours"),
        F.lit(False).alias("success"),
        F.lit(error).alias("error"),
    )


def align_rows(
    df, keys, data_type, ts="timestamp", target="1 min", fill="interpolate", order=None, sliced=None, rules=None
) -> DataFrame:
    """The rows of ``align``. ``rules`` names the aggregate per column (default: what suits the column)."""
    helpers = [c for c in (order or []) if c != ts]
    if data_type == "sleep":
        return df.drop(*helpers)
    seconds = FREQUENCIES[target]
    if sliced is None:
        sliced = has_large_series(df, keys)
    rules = rules or smart_rules(df, keys, ts, helpers)
    marked = with_guard(Series.of(df, keys, order or [ts], sliced), ts, seconds).done()
    kept = marked.filter(~F.col("resample")).select(*keys, ts, *rules)
    binned = resample(marked.filter("resample"), keys, ts, seconds, rules, order, True, sliced)
    numbers = numeric_columns(df.select(*rules))
    filled = fill_gaps(Series.of(binned, keys, [ts], sliced), fill, ts, numbers if fill == "interpolate" else None).done()
    kinds = {f.name: f.dataType for f in filled.schema.fields}
    kept = kept.select(*keys, ts, *[F.col(c).cast(kinds[c]).alias(c) for c in rules])
    return filled.select(*keys, ts, *rules).unionByName(kept)


def align_report(df, aligned, keys, data_type, ts, target, order=None, sliced=None) -> DataFrame:
    if data_type == "sleep":
        guard = series_extent(df, keys, ts).select(*keys, "rows", F.lit("daily").alias("frequency"))
    else:
        guard = expansion_guard(df, keys, ts, FREQUENCIES[target], order, sliced)
    after = series_extent(aligned, keys, ts).select(*keys, F.col("rows").alias("resampled_rows"), "span_hours")
    return attach(guard, after, keys).select(
        *keys,
        F.lit(data_type).alias("data_type"),
        F.col("rows").alias("original_rows"),
        F.col("frequency").alias("original_frequency"),
        F.lit(target).alias("target_frequency"),
        "resampled_rows",
        "span_hours",
        F.col("resampled_rows").isNotNull().alias("success"),
        F.when(F.col("resampled_rows").isNull(), F.lit(NO_ROWS_LEFT)).alias("error"),
    )


def flag_unusual_gaps(df: DataFrame, keys: list[str], ts: str, order=None, sliced=None) -> DataFrame:
    """``dst_transition``: the step from the row before is more than twice the median step."""
    series = with_gaps(Series.of(df, keys, order or [ts], sliced), ts)
    series = with_quantiles(series, ["gap_seconds"], [0.5], "_median_")
    wide = F.col("gap_seconds") > 2 * F.col("_median_gap_seconds")[0]
    series = series.with_columns({"dst_transition": F.coalesce(wide, F.lit(False))})
    return series.drop("gap_seconds", "_median_gap_seconds").done()
