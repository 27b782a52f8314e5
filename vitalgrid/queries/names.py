"""Columns and projections."""

from pyspark.sql import functions as F

from vitalgrid.functions.expressions import numeric_columns
from vitalgrid.operators import columns, forecast
from vitalgrid.queries.registry import R, query

TYPED = """
    SELECT event_id, user_id, ts, value,
           CASE event_type WHEN 'click' THEN 'steps' WHEN 'view' THEN 'heart_rate'
                           WHEN 'purchase' THEN 'sleep' ELSE event_type END AS data_type
    FROM events
"""


def typed(t):
    kind = (
        F.when(F.col("event_type") == "click", "steps")
        .when(F.col("event_type") == "view", "heart_rate")
        .when(F.col("event_type") == "purchase", "sleep")
        .otherwise(F.col("event_type"))
    )
    return t.events.select("event_id", "user_id", "ts", "value", kind.alias("data_type"))


def device_export(t):
    return t.events.select(
        F.col("event_id").alias("Event-Id"),
        F.col("ts").alias("DateTime"),
        F.col("user_id").alias("User ID"),
        F.col("value").alias("HR"),
        F.col("event_type").alias("Stage"),
    )


@query("p1_standardize_map_first", f"SELECT event_id, ts AS datetime, user_id, {R('value')} AS hr, event_type AS stage FROM events")
def _(t):
    return columns.standardize_columns(device_export(t), map_first=True)


@query(
    "p2_standardize_columns",
    f"SELECT event_id, ts AS timestamp, user_id, {R('value')} AS heart_rate, event_type AS sleep_stage FROM events",
)
def _(t):
    return columns.standardize_columns(device_export(t))


@query(
    "p3_detect_timestamp",
    "SELECT 'recorded' AS column_name, count(ts) AS filled, min(ts) AS first_seen, max(ts) AS last_seen FROM events",
)
def _(t):
    df = t.events.select("user_id", "value", "event_type", F.col("ts").cast("string").alias("recorded"))
    found = columns.detect_timestamp_column(df)
    at = columns.parse_timestamp(F.col(found))
    return df.agg(
        F.lit(found).alias("column_name"), F.count(at).alias("filled"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen")
    )


@query(
    "p4_parse_timestamps",
    """
    SELECT event_id, try_cast(CASE WHEN event_type = 'error' THEN event_type || ' ' || event_id
                                   ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp) AS parsed
    FROM events
    """,
)
def _(t):
    text = F.when(F.col("event_type") == "error", F.concat_ws(" ", "event_type", "event_id")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return t.events.select("event_id", columns.parse_timestamp(text).alias("parsed"))


@query(
    "p5_calendar_columns",
    """
    SELECT event_id, hour(ts) AS hour_of_day, dayname(ts) AS day_of_week, ts::date AS date,
           isodow(ts) >= 6 AS is_weekend
    FROM events
    """,
)
def _(t):
    return columns.add_calendar(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("p6_duration_hours", f"SELECT event_id, {R('value / 60')} AS duration_hours FROM events")
def _(t):
    df = t.events.select("event_id", F.col("value").alias("duration_minutes"))
    return columns.add_hours(df).select("event_id", "duration_hours")


@query(
    "p7_numeric_columns",
    f"""
    SELECT count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey, count(l_suppkey) AS l_suppkey,
           count(l_linenumber) AS l_linenumber, count(l_quantity) AS l_quantity,
           count(l_extendedprice) AS l_extendedprice, count(l_discount) AS l_discount, count(l_tax) AS l_tax
    FROM lineitem
    """,
)
def _(t):
    df = t.lineitem.withColumns({"l_tax_is_outlier": F.col("l_tax") > 0.07, "tax_anomaly": F.lit(1)})
    return df.agg(*[F.count(c).alias(c) for c in numeric_columns(df)])


@query(
    "p8_metric_values",
    f"""
    SELECT user_id, data_type, ts,
           {R("CASE data_type WHEN 'heart_rate' THEN value WHEN 'steps' THEN value * 10 ELSE value * 2 END")} AS value
    FROM ({TYPED}) WHERE data_type IN ('heart_rate', 'steps', 'sleep')
    """,
)
def _(t):
    wide = typed(t).select(
        "user_id",
        "data_type",
        "ts",
        F.col("value").alias("heart_rate"),
        (F.col("value") * 10).alias("step_count"),
        (F.col("value") * 2).alias("duration_minutes"),
    )
    return columns.metric_values_by_type(wide, "data_type", ["user_id"], "ts")


@query("p9_model_frame", f"SELECT user_id, ts, {R('value')} AS y FROM events WHERE event_type <> 'error'")
def _(t):
    gaps = t.events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return forecast.training_frame(gaps, ["user_id"], "ts", "value")


@query(
    "p10_long_form",
    f"""
    SELECT c_custkey, c_name, 'c_nationkey' AS metric, {R('c_nationkey')} AS value FROM customer
    UNION ALL SELECT c_custkey, c_name, 'c_acctbal', {R('c_acctbal')} FROM customer
    """,
)
def _(t):
    return columns.to_long(t.customer, ["c_custkey"], "c_name")
