"""The three stages over files of several data types at once.

Readings of all types and columns form one long table: (data_type, keys, metric, timestamp, value). A series
is a metric of one person in one data type. What differs by type or column (range, fill, aggregate,
threshold) is a row of a small rules table that is joined to the readings, so each stage is one plan
whatever the number of files and types. Only clusterings, which are models of their own, are made type by
type. Every series of every file has a status row that tells how far it came and why it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.catalog import (
    FREQUENCIES,
    METHODS,
    METRIC_COLUMN,
    NO_METRIC,
    NO_WINDOWS,
    NUMBERS,
    THRESHOLD_RULES,
    TOO_FEW_READINGS,
    UNKNOWN_TYPE,
    VALUE_RANGES,
)
from vitalgrid.functions.expressions import nan_to_null, share
from vitalgrid.operators import align, anomaly, clean, cluster, features, forecast, missing, quality
from vitalgrid.plans.series import Series, attach, has_large_series, spread
from vitalgrid.plans.stages import Reports, Stage
from vitalgrid.session import stored
from vitalgrid.sources.collection import Loaded, column_bit

TS = "timestamp"
ORDER = [TS, "source", "block", "line"]
#: Types with a value a day, which are not resampled.
DAILY = ["sleep"]
#: How many values a row counts for when series are cut: rows carry texts, and a task holds them several times.
WIDTH = 8


def rules(spark: SparkSession) -> DataFrame:
    """One row per data type and column: its range, how gaps are filled, how bins are aggregated, and the
    thresholds of the type's own metric."""
    rows = []
    for data_type in (*METRIC_COLUMN, "unknown"):
        for metric in NUMBERS:
            low, high, label = VALUE_RANGES.get(metric, (None, None, None))
            is_main = METRIC_COLUMN.get(data_type) == metric
            least, most, lasting = THRESHOLD_RULES[data_type] if is_main else (None, None, None)
            rows.append(
                (data_type, metric, is_main, *_floats(low, high), label, metric not in ("heart_rate", "step_count"),
                 metric in ("step_count", "duration_minutes"), *_floats(least, most), lasting)
            )
    show = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}D" if isinstance(v, float) else str(v)
    values = ", ".join(f"({', '.join(map(show, r))})" for r in rows)
    names = "data_type, metric, is_main, low, high, label, by_median, is_total, min_threshold, max_threshold, sustained"
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules({names})")


def _floats(*limits) -> list[float | None]:
    return [None if v is None else float(v) for v in limits]


def with_rules(df: DataFrame, *columns: str) -> DataFrame:
    """The wanted columns of the rules on every row; the rules are a few dozen rows."""
    table = rules(df.sparkSession).select("data_type", "metric", *columns)
    return df.join(F.broadcast(table), ["data_type", "metric"], "left")


def readings(loaded: Loaded, keys: list[str]) -> DataFrame:
    """One row per record and numeric column that the record's file has; absent values are null."""
    cells = [
        F.when(F.col("present").bitwiseAND(column_bit(c)) != 0, F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")))
        for c in NUMBERS
    ]
    cell = F.explode(F.array_compact(F.array(*cells))).alias("cell")
    return loaded.records.select("data_type", *keys, *ORDER, cell).select("data_type", *keys, *ORDER, "cell.*")


# stage 1 ---------------------------------------------------------------------------------------------


def preprocess(
    rows: DataFrame, keys: list[str], target: str = "1 min", fill: str = "interpolate", as_of=None
) -> Stage:
    """Check, fill, flag and align all series of ``readings``. Data: data_type, keys, metric, timestamp, value,
    value_is_outlier. Reports: ``validation`` and ``alignment``, one row per series.

    An unknown ``target`` leaves the checked rows unaligned, and the alignment report says so.
    """
    group = ["data_type", *keys, "metric"]
    rows = with_rules(nan_to_null(rows), "low", "high", "by_median")
    sliced = has_large_series(rows, group, WIDTH)
    outside = F.coalesce((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")), F.lit(False))
    clipped = F.when(F.col("value") < F.col("low"), F.col("low")).when(F.col("value") > F.col("high"), F.col("high"))
    checked = clean.drop_bad_timestamps(rows, TS, as_of, keep_null=True)
    checked = checked.withColumn("value", F.coalesce(clipped, F.col("value"))).drop("low", "high")

    timed = checked.filter(F.col(TS).isNotNull())
    series = Series.of(timed if sliced else spread(timed, group), group, ORDER, sliced).with_columns(
        {"_step": F.when(~F.col("by_median"), F.col("value")), "_middle": F.when(F.col("by_median"), F.col("value"))}
    )
    series = missing.median_fill(missing.interpolate_rows(series, ["_step"]), ["_middle"])
    series = series.with_columns({"value": F.when(F.col("by_median"), F.col("_middle")).otherwise(F.col("_step"))})
    flagged = quality.mark_outliers(series.drop("_step", "_middle", "by_median"), ["value"]).done()
    unique = clean.keep_first_times(Series(flagged, group, ORDER, False) if not sliced else Series.of(flagged, group, ORDER, True), TS).done()
    aligned = _aligned(unique, group, target, fill, sliced)
    return Stage(
        aligned,
        Reports(
            {
                "validation": lambda: _validation(rows, checked, flagged, unique, group, as_of, outside),
                "alignment": lambda: _alignment(rows, unique, aligned, group, target, sliced),
            }
        ),
    )


def _aligned(unique: DataFrame, group: list[str], target: str, fill: str, sliced: bool) -> DataFrame:
    kept = [*group, TS, "value", "value_is_outlier"]
    if target not in FREQUENCIES:
        return unique.select(*kept)
    daily = F.col("data_type").isin(*DAILY)
    total = F.col("is_total")
    rest = with_rules(unique.filter(~daily), "is_total").withColumns(
        {"_mean": F.when(~total, F.col("value")), "_sum": F.when(total, F.col("value"))}
    )
    how = {"_mean": "mean", "_sum": "sum", "value_is_outlier": "max"}
    rest = rest.select(*group, *ORDER, *how)
    rest = with_rules(align.align_rows(rest, group, "", TS, target, fill, ORDER, sliced, how), "is_total")
    rest = rest.withColumn("value", F.when(total, F.col("_sum")).otherwise(F.col("_mean")))
    return rest.select(*kept).unionByName(unique.filter(daily).select(*kept))


def _validation(rows, checked, flagged, unique, group, as_of, outside) -> DataFrame:
    tests = clean.timestamp_checks(TS, as_of)
    in_time = ~(tests["future"] | tests["old"])
    report = rows.groupBy(*group).agg(
        F.count("*").alias("original_rows"),
        *[F.count_if(c).alias(f"{n}_timestamps") for n, c in tests.items()],
        F.count_if(in_time & outside).alias("out_of_range"),
    )
    problems = [f"{n}_timestamps" for n in tests] + ["out_of_range"]
    count = reduce(Column.__add__, [F.when(F.col(p) > 0, 1).otherwise(0) for p in problems])
    report = report.withColumn("issues", count)
    scores = quality.quality_scores(unique, group, report.select(*group, "issues"), [TS, "value", "value_is_outlier"])
    scores = scores.select(*group, F.col("rows").alias("final_rows"), "quality_score")
    before = checked.groupBy(*group).agg(F.count_if(F.col("value").isNull()).alias("missing_before"))
    after = flagged.groupBy(*group).agg(
        F.count("*").alias("_timed"),
        F.count_if(F.col("value").isNull()).alias("missing_after"),
        F.count_if("value_is_outlier").alias("outliers"),
    )
    for part in (before, after, scores):
        report = attach(report, part, group)
    none = ("final_rows", "_timed", "missing_before", "missing_after", "outliers")
    report = report.withColumns({c: F.coalesce(c, F.lit(0)) for c in none})
    return report.withColumns(
        {"duplicates_removed": F.col("_timed") - F.col("final_rows"), "rows_removed": F.col("original_rows") - F.col("final_rows")}
    ).drop("_timed")


def _alignment(rows, unique, aligned, group, target, sliced) -> DataFrame:
    """Every series of the readings, also those of which no row is left."""
    seen = rows.groupBy(*group).agg(F.count("*").alias("_seen"))
    if target not in FREQUENCIES:
        found = align.failed_report(unique, group, "", target, f"'{target}'")
    else:
        daily = F.col("data_type").isin(*DAILY)
        found = reduce(
            DataFrame.union,
            [
                align.align_report(unique.filter(which), aligned.filter(which), group, kind, TS, target, ORDER, sliced)
                for kind, which in (("", ~daily), ("sleep", daily))
            ],
        )
    facts = ["original_rows", "original_frequency", "target_frequency", "resampled_rows", "span_hours", "success", "error"]
    # the report's own data_type column repeats the first of the keys
    found = found.toDF(*group, "_type", *facts).drop("_type")
    return attach(seen, found, group).select(
        *group,
        F.coalesce("original_rows", F.lit(0)).alias("original_rows"),
        "original_frequency",
        F.lit(target).alias("target_frequency"),
        "resampled_rows",
        "span_hours",
        F.coalesce("success", F.lit(False)).alias("success"),
        F.when(F.col("original_rows").isNull(), F.lit(align.NO_ROWS_LEFT)).otherwise(F.col("error")).alias("error"),
    )


# stage 2 ---------------------------------------------------------------------------------------------


class Models:
    """``matrix``: features of every window of every series, by data type; ``forecast`` and ``residuals`` of every
    series; ``clusters``: windows with their cluster, per data type. Each is computed when first asked for.
    Reports: ``extraction`` and ``modeling`` (per series), ``clustering`` (per data type)."""

    def __init__(self, build: dict[str, Callable[["Models"], object]], reports: dict[str, Callable[["Models"], DataFrame]]):
        self._build, self._done = build, {}
        self.reports = Reports({name: (lambda make=make: make(self)) for name, make in reports.items()})

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in self._build:
            raise AttributeError(name)
        if name not in self._done:
            self._done[name] = self._build[name](self)
        return self._done[name]


def main_values(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """The values of each type's own metric."""
    own = with_rules(aligned, "is_main").filter("is_main")
    return own.select("data_type", *keys, TS, "value")


def model(
    aligned: DataFrame, keys: list[str], requested: int = 60, periods: int = 100, forecaster: str = "seasonal_trend",
    method: str = "kmeans", k: int = 3,
) -> Models:
    """Window features, forecasts and clusters of each type's own metric, all types together. Series without
    that metric, of an unknown type, or with too few readings get a report row that says so."""
    group = ["data_type", *keys]
    main = main_values(aligned, keys)
    daily = F.col("data_type").isin(*DAILY)
    fit, predict = forecast.MODELS[forecaster]

    def matrix(models: Models) -> DataFrame:
        windows = features.to_windows(main.filter(~daily), group, "value", [TS], requested, models.sliced).unionByName(
            features.sleep_windows(main.filter(daily), group, TS, "value", models.sliced)
        )
        raw = stored(features.window_features(windows, group, "efficient"), "features")
        return stored(features.impute(raw, ["data_type"]), "matrix")

    return Models(
        {
            "sliced": lambda m: has_large_series(main, group, WIDTH),
            "matrix": matrix,
            "train": lambda m: forecast.training_frame(main, group, TS, "value", m.sliced),
            "fitted": lambda m: stored(fit(m.train, group, m.sliced), "models"),
            "forecast": lambda m: predict(m.fitted, forecast.future_grid(m.train, group, periods), group),
            "residuals": lambda m: forecast.with_residuals(predict(m.fitted, m.train, group)),
            "clustering": lambda m: _clusters(m.matrix, keys, method, k),
            "clusters": lambda m: m.clustering[0],
        },
        {
            "extraction": lambda m: _extraction(aligned, m.matrix, group),
            "modeling": lambda m: _modeling(aligned, m.residuals, group, forecaster, periods),
            "clustering": lambda m: m.clustering[1],
        },
    )


def _clusters(matrix: DataFrame, keys: list[str], method: str, k: int) -> tuple[DataFrame, DataFrame]:
    rows, reports = [], []
    for data_type in [r[0] for r in matrix.select("data_type").distinct().orderBy("data_type").collect()]:  # those of the catalog
        own = matrix.filter(F.col("data_type") == data_type)
        constant = features.constant_columns(own)
        names = [c for c in features.feature_columns(own) if c not in constant]
        numbered = Series.of(own, [], [*keys, "window_id"], False).position("window_no").done()
        labels, report = cluster.cluster_features(numbered, "window_no", names, data_type, method, k)
        rows.append(labels.select("data_type", *keys, "window_id", F.col("cluster").cast("int").alias("cluster")))
        reports.append(report)
    if not rows:
        none = matrix.select("data_type", *keys, "window_id", F.lit(0).alias("cluster")).filter("1 = 0")
        return none, none.select("data_type", F.lit(0).cast("long").alias("n_samples"))
    put = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    return reduce(put, rows), reduce(put, reports)


def _known(aligned: DataFrame, group: list[str]) -> DataFrame:
    """Per series of a data type: rows and values of its own metric, and why it has none."""
    own = with_rules(aligned, "is_main")
    seen = own.groupBy(*group).agg(
        F.count_if("is_main").alias("rows"), F.count(F.when(F.col("is_main"), F.col("value"))).alias("known")
    )
    names = F.create_map(*[F.lit(x) for pair in METRIC_COLUMN.items() for x in pair])
    return seen.withColumn(
        "_absent",
        F.when(~F.col("data_type").isin(*METRIC_COLUMN), F.format_string(UNKNOWN_TYPE, "data_type")).when(
            F.col("rows") == 0, F.format_string(NO_METRIC, names[F.col("data_type")])
        ),
    )


def _extraction(aligned: DataFrame, matrix: DataFrame, group: list[str]) -> DataFrame:
    windows = matrix.groupBy(*group).agg(F.count("*").alias("windows"))
    report = attach(_known(aligned, group), windows, group)
    error = F.coalesce("_absent", F.when(F.col("windows").isNull(), F.lit(NO_WINDOWS)))
    return report.select(
        *group, F.col("rows").alias("original_rows"), F.coalesce("windows", F.lit(0)).alias("windows"),
        error.isNull().alias("success"), error.alias("error"),
    )


def _modeling(aligned: DataFrame, residuals: DataFrame, group: list[str], forecaster: str, periods: int) -> DataFrame:
    report = attach(_known(aligned, group), forecast.accuracy(residuals, group), group)
    error = F.coalesce("_absent", F.when(F.col("mae").isNull(), F.lit(TOO_FEW_READINGS)))
    return report.select(
        *group, F.lit(forecaster).alias("model"), F.coalesce("training_rows", "known").alias("training_rows"),
        F.lit(periods).alias("forecast_periods"), "mae", "rmse", "mape", "mape_zero_rows",
        error.isNull().alias("success"), error.alias("error"),
    )


# stage 3 ---------------------------------------------------------------------------------------------


def detect(aligned: DataFrame, keys: list[str], models: Models | None = None, threshold_std: float = 3.0) -> Stage:
    """Threshold, residual and cluster flags for the rows of each type's own metric; rows of an unknown type
    stay, without flags. Reports: ``anomalies`` (per series and method), and with models ``windows`` (flagged
    windows) and ``clusters`` (anomalous windows per series)."""
    group = ["data_type", *keys]
    rows = with_rules(aligned, "is_main", "min_threshold", "max_threshold", "sustained")
    rows = rows.filter(F.col("is_main") | ~F.col("data_type").isin(*METRIC_COLUMN)).drop("is_main")
    sliced = has_large_series(rows, [*group, "metric"], WIDTH)
    flagged = anomaly.flag_thresholds_by_rule(rows, [*group, "metric"], [TS], "value", sliced)
    reports = {"threshold": "threshold_anomaly"}
    if models is not None:
        flagged = anomaly.flag_residuals(flagged, models.forecast, group, TS, "value", threshold_std)
        reports["residual"] = "residual_anomaly"

    def windows() -> DataFrame:
        return anomaly.flag_clusters(models.clusters, by=["data_type"])

    def anomalies() -> DataFrame:
        return reduce(DataFrame.unionByName, [_counted(flagged, group, method, flag) for method, flag in reports.items()])

    built = {"anomalies": anomalies}
    if models is not None:
        built |= {"windows": windows, "clusters": lambda: _counted(windows(), group, "cluster", "cluster_anomaly")}
    return Stage(flagged, Reports(built))


def _counted(df: DataFrame, group: list[str], method: str, flag: str) -> DataFrame:
    counted = df.groupBy(*group).agg(
        F.count("*").alias("total_records"), F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias("anomalies_detected")
    )
    percentage = 100 * share(F.col("anomalies_detected"), F.col("total_records"))
    return counted.select(*group, F.lit(METHODS[method]).alias("method"), "total_records", "anomalies_detected", percentage.alias("anomaly_percentage"))


# the whole run ---------------------------------------------------------------------------------------


@dataclass
class Run:
    """``files``: a row per file; ``status``: a row per file, data type and series."""

    loaded: Loaded
    keys: list[str]
    first: Stage
    second: Models
    threshold_std: float

    @property
    def files(self) -> DataFrame:
        return self.loaded.status

    @cached_property
    def third(self) -> Stage:
        return detect(self.first.data, self.keys, self.second, self.threshold_std)

    @cached_property
    def status(self) -> DataFrame:
        return _progress(self.loaded, self.first, self.second, self.keys)


def analyse(
    loaded: Loaded, keys: list[str], target: str = "1 min", fill: str = "interpolate", as_of=None, requested: int = 60,
    periods: int = 100, forecaster: str = "seasonal_trend", method: str = "kmeans", k: int = 3, threshold_std: float = 3.0,
) -> Run:
    """All stages over a loaded folder. The aligned table is written once; what follows reads it, and is
    computed when it is asked for."""
    rows = readings(loaded, keys)
    first = preprocess(rows, keys, target, fill, as_of)
    first = Stage(stored(first.data, "aligned"), first.reports)
    return Run(loaded, keys, first, model(first.data, keys, requested, periods, forecaster, method, k), threshold_std)


def _progress(loaded: Loaded, first: Stage, second: Models, keys: list[str]) -> DataFrame:
    """Per file, data type and series: rows read, rows aligned, windows, and the first error."""
    group = ["data_type", *keys]
    read = loaded.records.groupBy("source", *group).agg(F.count("*").alias("rows"))
    aligned = first.data.groupBy(*group).agg(F.count_distinct(TS).alias("aligned_rows"))
    extraction = second.reports["extraction"].select(*group, "windows", F.col("error").alias("_window_error"))
    modeling = second.reports["modeling"].select(*group, F.col("error").alias("_model_error"))
    for part in (aligned, extraction, modeling):
        read = attach(read, part, group)
    failed = loaded.status.filter("not success").select("source", F.col("error").alias("_load_error"), F.col("data_type").alias("_type"))
    rows = read.join(failed, "source", "full")
    none = F.col("aligned_rows").isNull() & F.col("_load_error").isNull()
    error = F.coalesce("_load_error", F.when(none, F.lit(align.NO_ROWS_LEFT)), "_model_error", "_window_error")
    return rows.select(
        "source", F.coalesce("data_type", "_type").alias("data_type"), *keys,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "aligned_rows", "windows")],
        error.isNull().alias("success"), error.alias("error"),
    )
