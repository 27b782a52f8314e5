"""Coverage counts, descriptive statistics, trends, extrema, findings, histograms."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import ANOMALY_SUFFIX, FINDINGS, METRIC_COLUMN, WEEKDAYS
from vitalgrid.functions.expressions import half_even, nan_is_missing, numeric_columns, share, title
from vitalgrid.functions.scan import INF, clamp_of, stands_out
from vitalgrid.functions.stats import slope_p_value_of
from vitalgrid.plans.series import Series, attach, has_large_series, spread
from vitalgrid.plans.summaries import quantiles

HOURS = list(range(24))


def hourly_counts(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.groupBy(*keys, F.hour(ts).alias("hour")).agg(F.count("*").alias("records"))


def _hour_pivot(df: DataFrame, rows: list[Column], ts: str, names: list[str]) -> DataFrame:
    wide = df.select(*rows, F.hour(ts).alias("_hour")).groupBy(*names).pivot("_hour", HOURS).count()
    return wide.select(*names, *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in HOURS])


def weekday_hour_coverage(df: DataFrame, ts: str, keys: list[str] = ()) -> DataFrame:
    """Rows per weekday and hour, Monday first."""
    day = F.date_format(ts, "EEEE").alias("day_of_week")
    wide = _hour_pivot(df, [*keys, day], ts, [*keys, "day_of_week"])
    rank = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("day_of_week"))
    return wide.orderBy(*keys, rank)


def date_hour_coverage(df: DataFrame, ts: str, keys: list[str] = ()) -> DataFrame:
    return _hour_pivot(df, [*keys, F.to_date(ts).alias("date")], ts, [*keys, "date"])


def hour_comparison(df: DataFrame, before: str, after: str, order: list[str], rows: int = 100) -> DataFrame:
    """Hours before and after a conversion for the first ``rows`` rows."""
    return df.orderBy(*order).limit(rows).select(
        *order, F.hour(before).alias("hour_before"), F.hour(after).alias("hour_after")
    )


@nan_is_missing
def long_statistics(
    df: DataFrame, dataset: str, columns: list[str] | None = None, approx: bool = False, sliced=None
) -> DataFrame:
    """One row per dataset and numeric column; ``dataset`` is the column that names the dataset."""
    columns = columns or numeric_columns(df, exclude=[dataset])
    parts = []
    for c in columns:
        parts += [
            F.avg(c).alias(f"mean_{c}"),
            F.stddev_samp(c).alias(f"std_{c}"),
            F.min(c).cast("double").alias(f"min_{c}"),
            F.max(c).cast("double").alias(f"max_{c}"),
        ]
    simple = df.groupBy(dataset).agg(F.count("*").alias("records"), *parts)
    medians = quantiles(df, [dataset], columns, [0.5], approx, sliced)
    both = attach(simple, medians.select(dataset, *[F.col(c)[0].alias(f"median_{c}") for c in columns]), [dataset])
    rows = F.array(
        *[
            F.struct(
                title(F.lit(c)).alias("metric"),
                *[F.col(f"{s}_{c}").cast("double").alias(s) for s in ("mean", "median", "std", "min", "max")],
            )
            for c in columns
        ]
    )
    return both.select(title(F.col(dataset)).alias("dataset"), "records", F.inline(rows))


STATISTICS = ["Mean", "Median", "Std Deviation", "Minimum", "Maximum", "Variance"]


def wide_comparison(long: DataFrame, dataset: str, datasets: list[str], value: str = "value") -> DataFrame:
    """Statistics as rows, datasets as columns, 2 decimals. ``long`` is (dataset, value)."""
    known = long.filter(F.col(value).isNotNull())
    simple = known.groupBy(dataset).agg(
        F.avg(value).alias("Mean"),
        F.stddev_samp(value).alias("Std Deviation"),
        F.min(value).cast("double").alias("Minimum"),
        F.max(value).cast("double").alias("Maximum"),
        F.var_samp(value).alias("Variance"),
    )
    median = quantiles(known, [dataset], [value], [0.5]).select(dataset, F.col(value)[0].alias("Median"))
    both = attach(simple, median, [dataset]).unpivot([dataset], STATISTICS, "statistic", "_v")
    wide = both.groupBy("statistic").pivot(dataset, datasets).agg(F.bround(F.max("_v"), 2))
    return wide.toDF("statistic", *[d.replace("_", " ").title() for d in datasets])


def compare_datasets(frames: dict[str, DataFrame]) -> DataFrame:
    """The same over a dict of tables: the main metric of each known data type."""
    long = None
    for name, df in frames.items():
        if name in METRIC_COLUMN and METRIC_COLUMN[name] in df.columns:
            part = df.select(F.lit(name).alias("dataset"), F.col(METRIC_COLUMN[name]).cast("double").alias("value"))
            long = part if long is None else long.unionByName(part)
    return wide_comparison(long, "dataset", [n for n in frames if n in METRIC_COLUMN])


@nan_is_missing
def correlations(df: DataFrame, columns: list[str] | None = None, keys: list[str] = ()) -> DataFrame:
    """Pearson correlation of every pair of numeric columns in one pass, pairwise nulls ignored;
    null against a constant column. Rows (a, b, correlation)."""
    keys = list(keys)
    columns = columns or numeric_columns(df, exclude=keys)
    if len(columns) < 2:
        raise ValueError("correlation needs two numeric columns")
    # plain sums of values shifted by the column mean: exact enough, and far cheaper per row than
    # one running central moment per pair
    values = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    centre = values.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns])
    shifted = attach(values, centre, keys).select(*keys, *[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sums = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a), F.col(b)
        both = x.isNotNull() & y.isNotNull()
        parts = {"n": F.lit(1.0), "x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}
        sums += [F.sum(F.when(both, e)).alias(f"_{n}{i}") for n, e in parts.items()]
    wide = shifted.groupBy(*keys).agg(*sums)
    cells = []
    for i, (a, b) in enumerate(pairs):
        n, x, y, xx, yy, xy = (F.col(f"_{s}{i}") for s in ("n", "x", "y", "xx", "yy", "xy"))
        spread = F.sqrt(F.greatest(xx - x * x / n, F.lit(0.0)) * F.greatest(yy - y * y / n, F.lit(0.0)))
        r = F.try_divide(xy - x * y / n, spread).alias("correlation")
        for first, second in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(first).alias("a"), F.lit(second).alias("b"), r))
    return wide.select(*keys, F.inline(F.array(*cells)))


@nan_is_missing
def flag_zscore(df: DataFrame, keys: list[str], column: str, threshold: float = 3.0) -> DataFrame:
    """``c_anomaly_zscore``: |value - mean| above ``threshold`` population deviations."""
    stats = df.groupBy(*keys).agg(F.avg(column).alias("_mean"), F.stddev_pop(column).alias("_std"))
    z = F.try_divide(F.abs(F.col(column) - F.col("_mean")), F.col("_std"))
    flag = F.coalesce(z > threshold, F.lit(False))
    return attach(df, stats, keys).withColumn(f"{column}{ANOMALY_SUFFIX}_zscore", flag).drop("_mean", "_std")


# extrema ---------------------------------------------------------------------------------------


def _field_names(df: DataFrame, names: list[str]) -> T.StructType:
    return T.StructType([df.schema[n] for n in names])


@nan_is_missing
def extrema(
    df: DataFrame,
    keys: list[str],
    value: str,
    order: list[str],
    prominence: float = 1.0,
    sliced: bool | None = None,
) -> DataFrame:
    """Strict local peaks and valleys with at least ``prominence``: (keys, pos, value, kind).

    Runs of equal values collapse to one row by window functions (a plateau counts once, at its
    middle). Prominence is one scan per direction over a series, or over a slice of a long series
    that starts from the state the earlier slices left.
    """
    known = df.filter(F.col(value).isNotNull()).select(*dict.fromkeys([*keys, *order, value]))
    if sliced is None:
        sliced = has_large_series(known, keys)
    if keys and not sliced:
        known = spread(known, keys)
    series = Series.of(known, keys, order, sliced)
    v = F.col(value)
    series = series.position("_pos").neighbours(previous={"_pv": v})
    series = series.on(series.df.filter(F.col("_pv").isNull() | (F.col("_pv") != v)).drop("_pv"))
    series = series.neighbours(previous={"_pv": v}, following={"_nv": v, "_np": F.col("_pos")})
    kind = F.when((F.col("_pv") < v) & (F.col("_nv") < v), F.lit(1)).when(
        (F.col("_pv") > v) & (F.col("_nv") > v), F.lit(-1)
    )
    series = series.with_columns(
        {"_kind": F.coalesce(kind, F.lit(0)), "pos": F.floor((F.col("_pos") + F.col("_np") - 1) / 2), "_v": v.cast("double")}
    )
    group = [*keys, "_slice"] if series.sliced else keys
    runs = series.df.select(*dict.fromkeys([*group, "_pos", "pos", "_v", "_kind"]))
    states = ["_pl", "_pr", "_vl", "_vr"]
    if series.sliced:
        runs = attach(runs, _slice_states(runs, keys, prominence), group)
        runs = runs.withColumns({s: F.coalesce(F.col(s), F.lit(INF)) for s in states})
    else:
        runs = runs.withColumns({s: F.lit(INF) for s in states})

    def scan(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        x, turn = table["_v"].to_numpy(), table["_kind"].to_numpy()
        pl, pr, vl, vr = (table[s][0].as_py() for s in states)
        keep = (turn == 1) & stands_out(x, prominence, pl, pr)
        keep |= (turn == -1) & stands_out(-x, prominence, vl, vr)
        found = table.filter(pa.array(keep))
        kinds = pa.array(["peak" if t == 1 else "valley" for t in turn[keep]], pa.string())
        return found.select([*keys, "pos", "_v"]).rename_columns([*keys, "pos", "value"]).append_column("kind", kinds)

    schema = T.StructType(
        [
            *_field_names(df, keys).fields,
            T.StructField("pos", T.LongType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("kind", T.StringType()),
        ]
    )
    return runs.groupBy(*group).applyInArrow(scan, schema)


def _slice_states(runs: DataFrame, keys: list[str], prominence: float) -> DataFrame:
    """The scan state at both edges of every slice, from one summary row per slice. Only series
    that are cut have such states; there are at most about as many of them as slices."""
    spans = runs.groupBy(*keys).agg(F.min("_slice").alias("_first"), F.max("_slice").alias("_last"))
    spans = spans.filter(F.col("_first") < F.col("_last"))
    runs = attach(runs, spans, keys).filter(F.col("_first").isNotNull()).drop("_first", "_last")
    names = ["pf0", "pf1", "pb0", "pb1", "vf0", "vf1", "vb0", "vb1"]
    key_fields = _field_names(runs, [*keys, "_slice"]).fields

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("_pos")["_v"].to_numpy()
        ends = [*clamp_of(x, prominence), *clamp_of(x[::-1], prominence)]
        ends += [*clamp_of(-x, prominence), *clamp_of(-x[::-1], prominence)]
        out = pdf[[*keys, "_slice"]].iloc[:1].copy()
        return out.assign(**dict(zip(names, ends)))

    summary = runs.groupBy(*keys, "_slice").applyInPandas(
        summarise, T.StructType([*key_fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    )

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_slice").reset_index(drop=True)

        def fold(low, high, backwards):
            state, states = INF, []
            pairs = list(zip(pdf[low], pdf[high]))
            for lo, hi in reversed(pairs) if backwards else pairs:
                states.append(state)
                state = min(max(state, lo), hi)
            return states[::-1] if backwards else states

        return pdf[[*keys, "_slice"]].assign(
            _pl=fold("pf0", "pf1", False),
            _pr=fold("pb0", "pb1", True),
            _vl=fold("vf0", "vf1", False),
            _vr=fold("vb0", "vb1", True),
        )

    states = [T.StructField(n, T.DoubleType()) for n in ("_pl", "_pr", "_vl", "_vr")]
    return summary.groupBy(*keys).applyInPandas(carry, T.StructType([*key_fields, *states]))


@nan_is_missing
def extrema_summary(df: DataFrame, keys: list[str], value: str, order: list[str], prominence: float = 1.0, sliced=None):
    """Counts and average heights per series; series without extrema are kept with zeros."""
    found = extrema(df, keys, value, order, prominence, sliced)
    parts = []
    for kind in ("peak", "valley"):
        hit = F.when(F.col("kind") == kind, F.col("value"))
        parts += [F.count(hit).alias(f"{kind}_count"), F.coalesce(F.avg(hit), F.lit(0.0)).alias(f"avg_{kind}_value")]
    summary = found.groupBy(*keys).agg(*parts)
    everyone = df.groupBy(*keys).agg(F.count(value).alias("_n")).drop("_n") if keys else None
    if not keys:
        return summary
    zeros = {c: F.coalesce(F.col(c), F.lit(0)) for c in summary.columns if c not in keys}
    return attach(everyone, summary, keys).withColumns(zeros)


@nan_is_missing
def trends(df: DataFrame, keys: list[str], value: str, order: list[str], sliced=None) -> DataFrame:
    """Linear trend of the non-null values on their row number; series with one value drop out."""
    known = df.filter(F.col(value).isNotNull()).select(*dict.fromkeys([*keys, *order, value]))
    rows = Series.of(known, keys, order, sliced).position("_x").done()
    y, x = F.col(value).cast("double"), F.col("_x").cast("double")
    fit = rows.groupBy(*keys).agg(
        F.count("*").alias("points"),
        F.regr_slope(y, x).alias("slope"),
        F.covar_pop(y, x).alias("_cov"),
        (F.stddev_pop(y) * F.stddev_pop(x)).alias("_spread"),
    )
    r = F.coalesce(F.try_divide(F.col("_cov"), F.col("_spread")), F.lit(0.0))
    r = F.greatest(F.lit(-1.0), F.least(r, F.lit(1.0)))
    fit = fit.filter(F.col("points") >= 2).withColumns({"_r": r, "r_squared": r * r})
    fit = fit.withColumn("p_value", slope_p_value_of(F.col("_r"), F.col("points").cast("double")))
    return fit.select(
        *keys,
        "points",
        "slope",
        "r_squared",
        "p_value",
        F.when(F.col("slope") > 0, F.lit("increasing")).otherwise(F.lit("decreasing")).alias("trend"),
        (F.col("p_value") < 0.05).alias("is_significant"),
    )


def _decimals(pattern: str) -> int:
    """Decimals of the pattern's numbers (one kind per pattern)."""
    return max(int(d) for d in re.findall(r"\.(\d)f", pattern))


def _finding(code: str, when: Column, *numbers: Column) -> Column:
    text = half_even(FINDINGS[code], _decimals(FINDINGS[code]), *numbers)
    return F.when(when, F.struct(F.lit(code).alias("code"), numbers[0].cast("double").alias("value"), text.alias("finding")))


@nan_is_missing
def findings(df: DataFrame, keys: list[str], data_type: str) -> DataFrame:
    """Rule-based findings: one row per series and rule that applies."""
    if data_type == "heart_rate" and "heart_rate" in df.columns:
        h = F.col("heart_rate")
        facts = df.groupBy(*keys).agg(F.avg(h).alias("_mean"), F.max(h).alias("_max"), F.stddev_samp(h).alias("_std"))
        mean, peak, std = F.col("_mean"), F.col("_max"), F.col("_std")
        rules = [
            _finding("hr_low", mean < 60, mean),
            _finding("hr_high", mean > 100, mean),
            _finding("hr_normal", ~((mean < 60) | (mean > 100)), mean),
            _finding("hr_variable", std > 15, std),
            _finding("hr_peak", peak > 180, peak),
        ]
    elif data_type == "steps" and "step_count" in df.columns:
        facts = df.groupBy(*keys).agg(F.sum("step_count").alias("_total"), F.avg("step_count").alias("_mean"))
        total, mean = F.coalesce(F.col("_total"), F.lit(0)), F.col("_mean")
        rules = [
            _finding("steps_goal", total >= 10000, total),
            _finding("steps_short", total < 10000, total, 10000 - total),
            _finding("steps_active", mean > 500, mean),
        ]
    elif data_type == "sleep" and "sleep_stage" in df.columns:
        duration = F.sum("duration_minutes") if "duration_minutes" in df.columns else F.lit(0)
        facts = df.groupBy(*keys).agg(
            duration.alias("_total"),
            F.count("*").alias("_rows"),
            F.count_if(F.col("sleep_stage") == "deep").alias("_deep"),
        )
        hours, some = F.col("_total") / 60, F.col("_total") > 0
        deep = 100 * share(F.col("_deep"), F.col("_rows"))
        rules = [
            _finding("sleep_good", some & (hours >= 7) & (hours <= 9), hours),
            _finding("sleep_short", some & (hours < 7), hours),
            _finding("sleep_long", some & (hours > 9), hours),
            _finding("sleep_deep", (F.col("_deep") > 0) & (deep >= 20), deep),
        ]
    else:
        facts, rules = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.lit(False)), []
    if not rules:
        empty = "array<struct<code:string,value:double,finding:string>>"
        return facts.select(*keys, F.inline(F.array().cast(empty)))
    return facts.select(*keys, F.inline(F.array_compact(F.array(*rules))))


@nan_is_missing
def histogram(df: DataFrame, keys: list[str], value: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value of a series, empty ones included;
    a constant series counts in bin 1."""
    known = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    ends = known.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    lo, hi, v = F.col("_lo"), F.col("_hi"), F.col("_v")
    width = hi - lo
    place = F.least(F.floor(F.coalesce(F.try_divide((v - lo) * bins, width), F.lit(0.0))) + 1, F.lit(bins))
    counts = attach(known, ends, keys).withColumn("bin", place.cast("int")).groupBy(*keys, "bin").agg(F.count("*").alias("records"))
    frame = ends.filter(lo.isNotNull()).withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    frame = frame.select(
        *keys,
        "bin",
        (lo + width * (F.col("bin") - 1) / bins).alias("lower"),
        (lo + width * F.col("bin") / bins).alias("upper"),
    )
    return attach(frame, counts, [*keys, "bin"]).withColumn("records", F.coalesce("records", F.lit(0)))


@nan_is_missing
def box_summary(df: DataFrame, keys: list[str], value: str, approx: bool = False, sliced=None) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 interquartile ranges), mean, deviation
    and the number of points beyond the whiskers."""
    known = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    q = quantiles(known, keys, ["_v"], [0.25, 0.5, 0.75], approx, sliced)
    q = q.select(*keys, *[F.col("_v")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    v = F.col("_v")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    rest = attach(known, q, keys).groupBy(*keys).agg(
        F.min(F.when(inside, v)).alias("lower_whisker"),
        F.max(F.when(inside, v)).alias("upper_whisker"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.count_if(~inside).alias("outliers"),
    )
    return attach(q, rest, keys)


@nan_is_missing
def outlier_points(df: DataFrame, keys: list[str], value: str, approx: bool = False, sliced=None) -> DataFrame:
    q = quantiles(df, keys, [value], [0.25, 0.75], approx, sliced)
    q = q.select(*keys, F.col(value)[0].alias("_q1"), F.col(value)[1].alias("_q3"))
    v, reach = F.col(value), 1.5 * (F.col("_q3") - F.col("_q1"))
    return attach(df, q, keys).filter((v < F.col("_q1") - reach) | (v > F.col("_q3") + reach)).drop("_q1", "_q3")


@nan_is_missing
def metric_summary(df: DataFrame, keys: list[str], value: str, order: list[str], sliced=None) -> DataFrame:
    """One row per series: mean, median, deviation, range, trend, anomalies, peaks and valleys."""
    if sliced is None:
        sliced = has_large_series(df, keys)
    v = F.col(value)
    facts = flag_zscore(df, keys, value).groupBy(*keys).agg(
        F.count("*").alias("data_points"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        (F.max(v) - F.min(v)).alias("range"),
        F.count_if(F.col(f"{value}{ANOMALY_SUFFIX}_zscore")).alias("anomalies"),
    )
    median = quantiles(df, keys, [value], [0.5], sliced=sliced).select(*keys, v[0].alias("median"))
    result = attach(facts, median, keys)
    result = attach(result, trends(df, keys, value, order, sliced), keys)
    result = attach(result, extrema_summary(df, keys, value, order, sliced=sliced), keys)
    label = F.when(F.col("is_significant"), F.initcap("trend")).otherwise(F.lit("Stable"))
    return result.withColumns(
        {
            "trend": label,
            "anomaly_percentage": 100 * share(F.col("anomalies"), F.col("data_points")),
            "trend_strength": F.when(F.col("is_significant"), F.col("r_squared")),
        }
    ).drop("is_significant", "points")
