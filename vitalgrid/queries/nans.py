"""NaN counts as missing: the operators on values of which some are NaN, their twins with null there."""

from pyspark.sql import functions as F

from vitalgrid.operators import anomaly, clean, describe, missing, quality
from vitalgrid.plans import stages
from vitalgrid.queries.registry import R, query

NAN = "event_id % 5 = 0"
KNOWN = f"(SELECT event_id, user_id, event_type, ts, CASE WHEN {NAN} THEN NULL ELSE value END AS v FROM events)"


def nans(t, name="v"):
    """A fifth of the values are NaN."""
    value = F.when(F.expr(NAN), F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", "user_id", "event_type", "ts", value.alias(name))


@query(
    "f4_nan",
    f"SELECT event_id, {R('CASE WHEN v < 30 THEN 30 WHEN v > 220 THEN 220 ELSE v END')} AS heart_rate, (v < 30 OR v > 220) IS TRUE AS was_out FROM {KNOWN}",
)
def _(t):
    df = nans(t, "heart_rate").select("event_id", "heart_rate")
    return clean.clip_ranges(df.withColumn("was_out", clean.out_of_range("heart_rate")))


@query(
    "m6_nan",
    f"""
    WITH k AS {KNOWN}, m AS (SELECT user_id, quantile_cont(v, 0.5) AS median FROM k GROUP BY user_id)
    SELECT event_id, {R('coalesce(v, median)')} AS v FROM k JOIN m USING (user_id)
    """,
)
def _(t):
    df = nans(t).select("event_id", "user_id", "ts", "v")
    filled, _report = missing.handle_missing(df, ["user_id"], "ts", ["ts", "event_id"], {"v": "median"})
    return filled.select("event_id", "v")


@query(
    "m6_nan_report",
    f"""
    WITH m AS (SELECT user_id, count(*) FILTER (v IS NULL) AS missing, count(v) AS known FROM {KNOWN} GROUP BY user_id)
    SELECT user_id, 'v' AS "column", missing AS missing_before, CASE WHEN known = 0 THEN missing ELSE 0 END AS missing_after,
        CASE WHEN missing > 0 THEN 'median' END AS strategy
    FROM m
    """,
)
def _(t):
    df = nans(t).select("event_id", "user_id", "ts", "v")
    _filled, report = missing.handle_missing(df, ["user_id"], "ts", ["ts", "event_id"], {"v": "median"})
    return report


@query(
    "q1_nan",
    f"""
    WITH k AS {KNOWN},
    q AS (SELECT event_type, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM k GROUP BY event_type)
    SELECT event_id, (v < a - 1.5::double * (b - a) OR v > b + 1.5::double * (b - a)) IS TRUE AS v_is_outlier FROM k JOIN q USING (event_type)
    """,
)
def _(t):
    flagged, _report = quality.flag_outliers(nans(t).select("event_id", "event_type", "v"), ["event_type"], ["v"])
    return flagged.select("event_id", "v_is_outlier")


@query(
    "a8_nan",
    f"""
    WITH k AS {KNOWN}, s AS (SELECT user_id, avg(v) AS m, stddev_pop(v) AS d FROM k GROUP BY user_id)
    SELECT event_id, coalesce(abs(v - m) / nullif(d, 0) > 1, false) AS v_anomaly_zscore FROM k JOIN s USING (user_id)
    """,
)
def _(t):
    return describe.flag_zscore(nans(t), ["user_id"], "v", 1.0).select("event_id", "v_anomaly_zscore")


@query(
    "n2_nan",
    f"""
    SELECT event_id, coalesce(v < 20 OR v > 80, false) AS threshold_violation,
        CASE WHEN v < 20 THEN 'High' WHEN v > 80 THEN 'Medium' ELSE 'Normal' END AS severity
    FROM {KNOWN}
    """,
)
def _(t):
    flagged = anomaly.flag_thresholds(nans(t), ["user_id"], "heart_rate", ["ts", "event_id"], "v", (20, 80, 0))
    return flagged.select("event_id", "threshold_violation", "severity")


# Q8 as a whole: other names, times as text of which some do not parse, NaN ----------------------------

RAW = f"""
    SELECT user_id, event_id, CASE WHEN {NAN} THEN NULL ELSE value * 3 END AS v,
        CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN ts - INTERVAL 20 YEAR ELSE ts END AS ts
    FROM events
"""


@query(
    "q8_raw_table",
    f"""
    WITH raw AS ({RAW}),
    f AS (SELECT user_id, count(*) AS rows, count(*) FILTER (ts IS NULL) AS bad, count(*) FILTER (ts < TIMESTAMP '2010-01-01') AS old,
              count(*) FILTER ((ts IS NULL OR ts >= TIMESTAMP '2010-01-01') AND (v < 30 OR v > 220)) AS far
          FROM raw GROUP BY user_id)
    SELECT user_id, rows AS original_rows, bad AS invalid_timestamps, old AS old_timestamps, far AS heart_rate_out_of_range,
        concat_ws('; ',
            CASE WHEN bad > 0 THEN format('Failed to parse {{}} timestamps ({{}}%)', bad, round_even((100.0 * bad / rows)::decimal(28, 10), 1)::decimal(9, 1)) END,
            CASE WHEN old > 0 THEN format('Found {{}} timestamps before 2010', old) END,
            CASE WHEN far > 0 THEN format('Heart rate: {{}} values outside range [30, 220]', far) END) AS issue_list
    FROM f
    """,
)
def _(t):
    value = F.when(F.expr(NAN), F.lit(float("nan"))).otherwise(F.col("value") * 3)
    text = (
        F.when(F.col("event_id") % 7 == 0, F.lit("not a time"))
        .when(F.col("event_id") % 11 == 0, F.expr("cast(ts - INTERVAL 20 YEARS as string)"))
        .otherwise(F.col("ts").cast("string"))
    )
    df = t.events.select(F.col("user_id"), F.col("event_id"), text.alias("Time"), value.alias("HR"))
    report = stages.validate(df, ["user_id"], "timestamp", ["timestamp", "event_id"], "2100-01-01 00:00:00").reports["validation"]
    return report.select(
        "user_id", "original_rows", "invalid_timestamps", "old_timestamps", "heart_rate_out_of_range",
        F.array_join("issue_list", "; ").alias("issue_list"),
    )


@query(
    "f3_text_times",
    f"""
    SELECT user_id, count(*) AS rows, count(*) FILTER (event_id % 7 = 0) AS invalid_timestamps,
        {R("round_even((100.0 * count(*) FILTER (event_id % 7 = 0) / count(*))::decimal(28, 10), 1)")} AS invalid_percentage
    FROM events GROUP BY user_id
    """,
)
def _(t):
    text = F.when(F.col("event_id") % 7 == 0, F.lit("31/31/2024")).otherwise(F.col("ts").cast("string"))
    report = clean.timestamp_report(t.events.select("user_id", text.alias("ts")), ["user_id"], "ts")
    return report.select("user_id", "rows", "invalid_timestamps", "invalid_percentage")
