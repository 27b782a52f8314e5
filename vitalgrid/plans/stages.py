"""The three stages in order: preprocess, model, detect."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import ISSUES, METRIC_COLUMN, VALUE_RANGES
from vitalgrid.functions.expressions import nan_to_null
from vitalgrid.operators import align as alignment
from vitalgrid.operators import anomaly, clean, cluster, columns, features, forecast, missing, quality
from vitalgrid.plans.series import Series, attach, has_large_series
from vitalgrid.session import stored


class Reports(Mapping):
    """Reports by name, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def and_also(self, builders: dict[str, Callable[[], DataFrame]]) -> "Reports":
        return Reports({n: (lambda n=n: self[n]) for n in self} | builders)


@dataclass
class Stage:
    """Rows and reports of a stage; everything is lazy."""

    data: DataFrame
    reports: Reports


def validate(
    df: DataFrame,
    keys: list[str],
    ts: str = "timestamp",
    order: list[str] | None = None,
    as_of=None,
    ranges: dict | None = None,
    how: dict[str, str] | None = None,
    sliced: bool | None = None,
) -> Stage:
    """Check times and ranges, fill what is missing, flag outliers, drop repeated times, score.
    The rows need one exchange on the keys; the reports are separate lazy aggregates.

    A table without the column ``ts`` gets standard column names first, and the time column is then
    found by its name. Text times are parsed; those that do not parse count as invalid and go. NaN
    counts as missing.

    Reports: ``validation`` (one row per series), ``missing`` and ``outliers`` (per column).
    """
    df, keys, ts, order = standard_table(df, keys, ts, order)
    if sliced is None:
        sliced = has_large_series(df, keys)
    ranges = {c: r for c, r in (ranges or VALUE_RANGES).items() if c in df.columns}
    checked = clean.drop_bad_timestamps(df, ts, as_of, keep_null=True)
    clipped = clean.clip_ranges(checked, ranges)
    how = how if how is not None else missing.strategies(clipped, keys, ts, order)
    series = Series.of(clipped.filter(F.col(ts).isNotNull()), keys, order, sliced)
    series = missing.fill_missing(series, how)
    numbers = quality.numeric_columns(series.done(), exclude=[*keys, *order])
    series = quality.mark_outliers(series, numbers)
    flagged = series.done()
    unique = clean.keep_first_times(series, ts).done()

    return Stage(
        unique,
        Reports(
            {
                "validation": lambda: _validation_report(df, flagged, unique, keys, ts, order, as_of, ranges),
                "missing": lambda: missing.missing_report(clipped, flagged, keys, how),
                "outliers": lambda: quality.outlier_report(
                    flagged, quality.iqr_bounds(flagged, keys, numbers, sliced=sliced), keys, numbers
                ),
            }
        ),
    )


def standard_table(df: DataFrame, keys: list[str], ts: str, order: list[str] | None):
    """The table ready for validation: names, time column, parsed times, NaN as null. Returns it with
    the names of its keys, time and order."""
    order = list(order or [ts])
    if ts not in df.columns:
        df = columns.standardize_columns(df)
        found = columns.detect_timestamp_column(df)
        keys = [columns.standard_name(k) for k in keys]
        order = [found if c == ts else columns.standard_name(c) for c in order]
        ts = found
    if isinstance(df.schema[ts].dataType, T.StringType):
        df = df.withColumn(ts, columns.parse_timestamp(F.col(ts)))
    return nan_to_null(df), list(keys), ts, order


def _validation_report(df, flagged, unique, keys, ts, order, as_of, ranges) -> DataFrame:
    """One row per series: rows before and after, what was wrong, score."""
    tests = clean.timestamp_checks(ts, as_of)
    in_time = ~(tests["future"] | tests["old"])
    issues = df.groupBy(*keys).agg(
        F.count("*").alias("original_rows"),
        *[F.count_if(c).alias(f"{n}_timestamps") for n, c in tests.items()],
        *[F.count_if(in_time & clean.out_of_range(c, ranges)).alias(f"{c}_out_of_range") for c in ranges],
    )
    count = F.lit(0)
    for problem in [f"{n}_timestamps" for n in tests] + [f"{c}_out_of_range" for c in ranges]:
        count = count + F.when(F.col(problem) > 0, 1).otherwise(0)
    issues = issues.withColumn("issues", count)
    scored = [c for c in unique.columns if c not in keys and (c not in order or c == ts)]
    scores = quality.quality_scores(unique, keys, issues.select(*keys, "issues"), scored)
    scores = scores.select(*keys, F.col("rows").alias("_final"), "quality_score")
    before = flagged.groupBy(*keys).agg(F.count("*").alias("_before"))
    report = attach(attach(issues, scores, keys), before, keys)
    final = F.coalesce("_final", F.lit(0))
    report = report.withColumns(
        {
            "final_rows": final,
            "duplicates_removed": F.coalesce("_before", F.lit(0)) - final,
            "rows_removed": F.col("original_rows") - final,
            "issue_list": issue_texts(ranges),
        }
    )
    return report.drop("_before", "_final")


def issue_texts(ranges: dict) -> Column:
    texts = [
        F.when(
            F.col("invalid_timestamps") > 0,
            F.format_string(
                ISSUES["invalid"],
                F.col("invalid_timestamps"),
                F.bround(100 * F.col("invalid_timestamps") / F.col("original_rows"), 1),
            ),
        ),
        F.when(F.col("future_timestamps") > 0, F.format_string(ISSUES["future"], F.col("future_timestamps"))),
        F.when(F.col("old_timestamps") > 0, F.format_string(ISSUES["old"], F.col("old_timestamps"))),
    ]
    for c, (low, high, label) in ranges.items():
        hits = F.col(f"{c}_out_of_range")
        texts.append(F.when(hits > 0, F.format_string(ISSUES["range"] % (label, low, high), hits)))
    return F.array_compact(F.array(*texts))


def preprocess(
    df: DataFrame,
    keys: list[str],
    data_type: str,
    ts: str = "timestamp",
    target: str = "1 min",
    fill: str = "interpolate",
    order: list[str] | None = None,
    as_of=None,
    ranges: dict | None = None,
) -> Stage:
    """Validate, then align to the target frequency. Adds the ``summary`` report: records, columns,
    quality, hours covered per series."""
    df, keys, ts, order = standard_table(df, keys, ts, order)
    sliced = has_large_series(df, keys)
    checked = validate(df, keys, ts, order, as_of, ranges, sliced=sliced)
    aligned = alignment.align_rows(checked.data, keys, data_type, ts, target, fill, order, sliced)
    report = lambda: alignment.align_report(
        checked.data, aligned, keys, data_type, ts, target, order, sliced
    )

    def summary() -> DataFrame:
        extent = alignment.series_extent(aligned, keys, ts)
        scores = checked.reports["validation"].select(*keys, "quality_score")
        return attach(extent, scores, keys).select(
            *keys,
            F.lit(data_type).alias("data_type"),
            F.col("rows").alias("records"),
            F.lit(len(aligned.columns) - len(keys)).alias("columns"),
            "quality_score",
            "span_hours",
        )

    return Stage(aligned, checked.reports.and_also({"alignment": report, "summary": summary}))


@dataclass
class Model:
    features: DataFrame
    forecast: DataFrame
    residuals: DataFrame
    clusters: DataFrame
    reports: Reports


def model(
    df: DataFrame,
    keys: list[str],
    data_type: str,
    ts: str = "timestamp",
    value: str | None = None,
    requested: int = 60,
    periods: int = 100,
    method: str = "kmeans",
    k: int = 3,
    forecaster: str = "seasonal_trend",
) -> Model:
    """Window features, a forecast per series, and clusters of all windows of the data type."""
    value = value or METRIC_COLUMN[data_type]
    matrix, extraction = features.extract_features(df, keys, data_type, value, ts, [ts], requested)
    numbered = Series.of(matrix, [], [*keys, "window_id"]).position("window_no").done()
    predicted, residuals, modelling = forecast.fit_and_predict(df, keys, data_type, ts, value, periods, forecaster)
    names = features.feature_columns(matrix)
    labelled, clustering = cluster.cluster_features(numbered, "window_no", names, data_type, method, k)
    projected, variance = cluster.pca(cluster.with_vector(cluster.standardize(labelled, names), names))
    return Model(
        matrix,
        predicted,
        residuals,
        attach(labelled, projected.select("window_no", "pc1", "pc2"), ["window_no"]),
        Reports(
            {
                "extraction": lambda: extraction,
                "modeling": lambda: modelling,
                "clustering": lambda: clustering,
                "pca": lambda: variance,
                "top_features": lambda: features.top_features(matrix, 10),
                "forecast_outliers": lambda: forecast.residual_outliers(residuals, keys),
            }
        ),
    )


def detect(
    df: DataFrame,
    keys: list[str],
    data_type: str,
    ts: str = "timestamp",
    value: str | None = None,
    order: list[str] | None = None,
    forecast: DataFrame | None = None,
    clusters: DataFrame | None = None,
    rule: tuple | None = None,
    threshold_std: float = 3.0,
) -> Stage:
    """Threshold flags, residual flags when a forecast is given, cluster flags when labelled windows
    are given. Reports per series, and ``windows`` with the flagged windows."""
    value = value or METRIC_COLUMN[data_type]
    flagged = anomaly.flag_thresholds(df, keys, data_type, order or [ts], value, rule)
    reports = {"threshold": lambda: anomaly.threshold_report(flagged, keys, data_type, rule)}
    if forecast is not None:
        flagged = anomaly.flag_residuals(flagged, forecast, keys, ts, value, threshold_std)
        reports["residual"] = lambda: anomaly.residual_report(flagged, keys, data_type, threshold_std)
    if clusters is not None:
        windows = anomaly.flag_clusters(clusters)
        reports["windows"] = lambda: windows
        reports["cluster"] = lambda: anomaly.cluster_flag_report(windows, [], data_type)
        reports["cluster_distribution"] = lambda: anomaly.cluster_distribution(windows)
    return Stage(flagged, Reports(reports))


def analyse(df: DataFrame, keys: list[str], data_type: str, ts: str = "timestamp", **options) -> tuple[Stage, Model, Stage]:
    """All three stages for one data type. The aligned rows are written once to the shared folder:
    every later step reads them there instead of repeating the first stage."""
    early = {n: options[n] for n in ("target", "fill", "order", "as_of", "ranges") if n in options}
    middle = {n: options[n] for n in ("requested", "periods", "method", "k", "forecaster") if n in options}
    late = {n: options[n] for n in ("rule", "threshold_std") if n in options}
    first = preprocess(df, keys, data_type, ts, **early)
    first = replace(first, data=stored(first.data, "aligned"))
    second = model(first.data, keys, data_type, ts, **middle)
    third = detect(first.data, keys, data_type, ts, forecast=second.forecast, clusters=second.clusters, **late)
    return first, second, third
