"""Threshold, residual and cluster anomalies, and the tables that summarise them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import ANOMALY_SUFFIX, METHODS, METRIC_COLUMN, REASONS, SEVERITIES, THRESHOLD_RULES
from vitalgrid.functions.expressions import any_of, nan_is_missing, share, title
from vitalgrid.plans.series import Series, attach, has_large_series, spread

BAND = ["yhat_lower", "yhat_upper"]


def rule_for(data_type: str) -> tuple | None:
    return THRESHOLD_RULES.get(data_type)


def _number(limit) -> str:
    return str(int(limit)) if float(limit).is_integer() else str(limit)


@nan_is_missing
def flag_thresholds(
    df: DataFrame,
    keys: list[str],
    data_type: str,
    order: list[str],
    value: str | None = None,
    rule: tuple | None = None,
    sliced: bool | None = None,
) -> DataFrame:
    """Add threshold_violation, threshold_anomaly, anomaly_reason and severity.

    A rule is (minimum, maximum, sustained rows). A sustained rule flags a row when it and the
    rows before it, as many as the rule asks for, all violate the same side: the distance to the
    last row that did not violate tells that without a frame per rule length. Unknown types and
    missing columns leave the table as it is.
    """
    rule = rule or rule_for(data_type)
    value = value or METRIC_COLUMN.get(data_type)
    if rule is None or value not in df.columns:
        return df
    low, high, sustained = rule
    over = F.coalesce(F.col(value) > high, F.lit(False))
    under = F.coalesce(F.col(value) < low, F.lit(False))
    if sustained:
        series = Series.of(df, keys, order, sliced).position("_pos")
        pos = F.col("_pos")
        series = series.known(before={"_not_over": F.when(~over, pos), "_not_under": F.when(~under, pos)})
        df = series.done()
        hot = pos - F.coalesce("_not_over", F.lit(-1)) >= sustained
        cold = pos - F.coalesce("_not_under", F.lit(-1)) >= sustained
        texts = [
            REASONS["sustained_low"] % (value, _number(low)),
            REASONS["sustained_high"] % (value, _number(high)),
        ]
        first, second, levels = (cold, hot, ("Medium", "High"))
    else:
        texts = [REASONS["instant_low"] % value, REASONS["instant_high"] % value]
        first, second, levels = (under, over, ("High", "Medium"))

    def choose(if_low, if_high, otherwise) -> Column:
        return F.when(first, F.lit(if_low)).when(second, F.lit(if_high)).otherwise(F.lit(otherwise))

    return df.withColumns(
        {
            "threshold_violation": over | under,
            "threshold_anomaly": first | second,
            "anomaly_reason": choose(*texts, ""),
            "severity": choose(*levels, "Normal"),
        }
    ).drop("_pos", "_not_over", "_not_under")


@nan_is_missing
def flag_thresholds_by_rule(
    df: DataFrame, keys: list[str], order: list[str], value: str, sliced: bool | None = None
) -> DataFrame:
    """The same for a table of several data types, where each row carries its rule: min_threshold,
    max_threshold and sustained (0: every violation counts), and ``metric``, the name used in
    reasons. Rows without a rule get no flags."""
    low, high, lasting = F.col("min_threshold"), F.col("max_threshold"), F.col("sustained")
    over = F.coalesce(F.col(value) > high, F.lit(False))
    under = F.coalesce(F.col(value) < low, F.lit(False))
    pos = F.col("_pos")
    series = Series.of(df, keys, order, sliced).position("_pos")
    rows = series.known(before={"_not_over": F.when(~over, pos), "_not_under": F.when(~under, pos)}).done()
    run = F.greatest(lasting, F.lit(1))
    hot = pos - F.coalesce("_not_over", F.lit(-1)) >= run
    cold = pos - F.coalesce("_not_under", F.lit(-1)) >= run
    steady = lasting > 0

    def text(kind: str, limit: Column | None = None) -> Column:
        shown = [] if limit is None else [F.when(limit == F.floor(limit), limit.cast("long").cast("string")).otherwise(limit.cast("string"))]
        return F.format_string(REASONS[kind], F.col("metric"), *shown)

    low_text = F.when(steady, text("sustained_low", low)).otherwise(text("instant_low"))
    high_text = F.when(steady, text("sustained_high", high)).otherwise(text("instant_high"))
    low_level = F.when(steady, F.lit("Medium")).otherwise(F.lit("High"))
    high_level = F.when(steady, F.lit("High")).otherwise(F.lit("Medium"))
    ruled = lasting.isNotNull()
    return rows.withColumns(
        {
            "threshold_violation": F.when(ruled, over | under),
            "threshold_anomaly": F.when(ruled, hot | cold),
            "anomaly_reason": F.when(ruled & cold, low_text).when(ruled & hot, high_text).when(ruled, F.lit("")),
            "severity": F.when(ruled & cold, low_level).when(ruled & hot, high_level).when(ruled, F.lit("Normal")),
        }
    ).drop("_pos", "_not_over", "_not_under", "min_threshold", "max_threshold", "sustained")


def flag_report(
    df: DataFrame, keys: list[str], data_type: str | Column, method: str, flag: str, extra: list[Column] = ()
) -> DataFrame:
    """One row per series: method, rows, anomalies, percentage."""
    kind = F.lit(data_type) if isinstance(data_type, str) else data_type
    hits = F.count_if(F.col(flag)) if flag in df.columns else F.lit(0)
    counted = df.groupBy(*keys).agg(F.count("*").alias("total_records"), hits.alias("anomalies_detected"), *extra)
    kept = [c for c in counted.columns if c not in (*keys, "total_records", "anomalies_detected")]
    return counted.select(
        *keys,
        kind.alias("data_type"),
        F.lit(METHODS[method]).alias("method"),
        "total_records",
        "anomalies_detected",
        F.coalesce(100 * share(F.col("anomalies_detected"), F.col("total_records")), F.lit(0.0)).alias("anomaly_percentage"),
        *kept,
    )


def threshold_report(df: DataFrame, keys: list[str], data_type: str, rule: tuple | None = None) -> DataFrame:
    rule = rule or rule_for(data_type)
    report = flag_report(df, keys, data_type, "threshold", "threshold_anomaly")
    if rule is None:
        return report
    names = ("min_threshold", "max_threshold", "sustained_minutes")
    return report.withColumns({n: F.lit(v) for n, v in zip(names, rule)})


@nan_is_missing
def flag_residuals(
    df: DataFrame, forecast: DataFrame, keys: list[str], ts: str, value: str, threshold_std: float = 3.0
) -> DataFrame:
    """``residual_anomaly``: the residual is larger than ``threshold_std`` sample deviations, or the
    value lies outside the forecast interval. Rows without a forecast are not flagged.

    Rows and forecast go through one exchange on the keys and meet in a window of equal times. Only
    series too long for a task are matched by a join. ``forecast`` has one row per series and time."""
    numbers = F.struct(F.col("yhat").cast("double").alias("predicted"), *[F.col(c).cast("double").alias(c) for c in BAND])
    slim = forecast.select(*keys, F.col("ts").alias(ts), numbers.alias("_forecast"))
    both = df.withColumn("_row", F.lit(True)).unionByName(slim, allowMissingColumns=True)
    if keys and not has_large_series(both, keys):
        at_time, whole = Window.partitionBy(*keys, ts), Window.partitionBy(*keys)
        rows = spread(both, keys).withColumn("_forecast", F.max("_forecast").over(at_time)).filter("_row")
        rows = rows.select(*df.columns, "_forecast.*").withColumn("residual", F.col(value) - F.col("predicted"))
        rows = rows.withColumn("_std", F.stddev_samp("residual").over(whole))
    else:
        rows = attach(df, slim, [*keys, ts]).select(*df.columns, "_forecast.*")
        rows = rows.withColumn("residual", F.col(value) - F.col("predicted"))
        rows = attach(rows, rows.groupBy(*keys).agg(F.stddev_samp("residual").alias("_std")), keys)
    far = F.abs("residual") > threshold_std * F.col("_std")
    outside = (F.col(value) > F.col("yhat_upper")) | (F.col(value) < F.col("yhat_lower"))
    flag = F.coalesce(far, F.lit(False)) | F.coalesce(outside, F.lit(False))
    return rows.withColumn("residual_anomaly", flag).withColumn(
        "residual_anomaly_reason", F.when(F.col("residual_anomaly"), REASONS["residual"]).otherwise("")
    ).drop("_std")


def residual_report(df: DataFrame, keys: list[str], data_type: str, threshold_std: float = 3.0) -> DataFrame:
    std = F.stddev_samp("residual")
    extra = [
        F.avg("residual").alias("residual_mean"),
        std.alias("residual_std"),
        (std * threshold_std).alias("residual_threshold"),
    ]
    return flag_report(df, keys, data_type, "residual", "residual_anomaly", extra)


def flag_clusters(
    labelled: DataFrame, threshold: float = 0.05, by: list[str] = (), label: str = "cluster"
) -> DataFrame:
    """``cluster_anomaly``: noise (label -1), or a cluster with less than ``threshold`` of all rows."""
    by = list(by)
    sizes = labelled.groupBy(*by, label).agg(F.count("*").alias("_size"))
    totals = sizes.groupBy(*by).agg(F.sum("_size").alias("_total"))
    sizes = attach(sizes, totals, by)
    rows = attach(labelled, sizes, [*by, label])
    noise = F.col(label) == -1
    small = share(F.col("_size"), F.col("_total")) < threshold
    reason = F.when(noise, F.lit(REASONS["noise"])).when(
        small, F.format_string(REASONS["small_cluster"], F.col(label).cast("long"))
    )
    return rows.withColumns(
        {"cluster_anomaly": noise | small, "cluster_anomaly_reason": F.coalesce(reason, F.lit(""))}
    ).drop("_size", "_total")


def cluster_distribution(flagged: DataFrame, by: list[str] = (), label: str = "cluster") -> DataFrame:
    """One row per cluster (per ``by``): its rows, and whether it is anomalous."""
    return flagged.groupBy(*by, label).agg(
        F.count("*").alias("records"), (F.count_if("cluster_anomaly") > 0).alias("anomalous"), F.count_if("cluster_anomaly").alias("anomalies")
    )


def cluster_flag_report(flagged: DataFrame, by: list[str], data_type: str, label: str = "cluster") -> DataFrame:
    """One row (per ``by``): rows, anomalies, clusters and anomalous clusters. The clusters themselves are the
    rows of ``cluster_distribution``, however many there are."""
    by = list(by)
    report = cluster_distribution(flagged, by, label).groupBy(*by).agg(
        F.sum("records").alias("total_records"),
        F.sum("anomalies").alias("anomalies_detected"),
        F.count("*").alias("total_clusters"),
        F.count_if("anomalous").alias("anomalous_clusters"),
    )
    return report.select(
        *by,
        F.lit(data_type).alias("data_type"),
        F.lit(METHODS["cluster"]).alias("method"),
        "total_records",
        "anomalies_detected",
        (100 * share(F.col("anomalies_detected"), F.col("total_records"))).alias("anomaly_percentage"),
        "total_clusters",
        "anomalous_clusters",
    )


def split_by_flags(df: DataFrame) -> dict[str, DataFrame]:
    """Row sets behind the views: normal, violating, sustained, residual, cluster."""
    anomaly = anomaly_columns(df)
    sets = {"normal": df.filter(~any_of([c for c in ("threshold_violation", *anomaly) if c in df.columns]))}
    for name, flag in {
        "violating": "threshold_violation",
        "sustained": "threshold_anomaly",
        "residual": "residual_anomaly",
        "cluster": "cluster_anomaly",
    }.items():
        if flag in df.columns:
            sets[name] = df.filter(F.col(flag))
    return sets


def violation_log(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Every violating row and every flagged residual or cluster row, one log row per method."""
    parts = []
    for method, flag in (
        ("threshold", "threshold_violation"),
        ("residual", "residual_anomaly"),
        ("cluster", "cluster_anomaly"),
    ):
        if flag in df.columns:
            hits = df.filter(F.col(flag))
            parts.append(hits.select(*keys, ts, F.col(value).alias("value"), F.lit(METHODS[method]).alias("method")))
    return reduce(DataFrame.unionByName, parts)


# summaries over data types ---------------------------------------------------------------------


def breakdown(reports: DataFrame) -> DataFrame:
    """Anomalies and percentage per data type and method, from per-series reports."""
    summed = reports.groupBy("data_type", "method").agg(
        F.sum("anomalies_detected").alias("anomalies"), F.sum("total_records").alias("_rows")
    )
    return summed.select(
        title(F.col("data_type")).alias("data_type"),
        "method",
        "anomalies",
        F.bround(100 * share(F.col("anomalies"), F.col("_rows")), 2).alias("percentage"),
    )


def breakdown_totals(reports: DataFrame) -> DataFrame:
    return reports.agg(
        F.sum("anomalies_detected").alias("total_anomalies"),
        F.count_distinct("method").alias("methods_used"),
        F.count_distinct("data_type").alias("types_analysed"),
    )


def anomaly_columns(df: DataFrame, anywhere: bool = False) -> list[str]:
    """Boolean flag columns, by suffix, or with the word anywhere in the name."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.BooleanType)
        and (ANOMALY_SUFFIX[1:] in f.name.lower() if anywhere else f.name.endswith(ANOMALY_SUFFIX))
    ]


def anomaly_totals(df: DataFrame, type_column: str = "data_type") -> DataFrame:
    """Set flags per data type, over all flag columns."""
    total = F.lit(0)
    for c in anomaly_columns(df):
        total = total + F.count_if(F.col(c))
    return df.groupBy(type_column).agg(total.alias("anomalies"))


def average_totals(totals: DataFrame) -> DataFrame:
    return totals.agg(
        F.count("*").alias("types_analysed"),
        F.sum("anomalies").alias("total_anomalies"),
        F.avg("anomalies").alias("avg_per_type"),
    )


def timeline(df: DataFrame, ts: str, type_column: str = "data_type") -> DataFrame:
    return df.filter(any_of(anomaly_columns(df, anywhere=True))).select(type_column, F.col(ts))


def severity_counts(df: DataFrame, severity: str = "severity") -> DataFrame:
    """Rows per severity, absent severities as zero; Normal is left out."""
    counts = [F.count_if(F.col(severity) == s).alias(s) for s in SEVERITIES]
    rows = F.array(*[F.struct(F.lit(s).alias("severity"), F.col(s).alias("records")) for s in SEVERITIES])
    return df.agg(*counts).select(F.inline(rows))


def anomalous_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows with any flag set, tagged with their data type, over a dict of tables."""
    parts = []
    for data_type, df in frames.items():
        flags = anomaly_columns(df, anywhere=True)
        if flags:
            parts.append(df.filter(any_of(flags)).withColumn("data_type", F.lit(data_type)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
