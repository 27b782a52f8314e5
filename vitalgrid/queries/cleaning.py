"""Filters, missing values, duplicates."""

from pyspark.sql import functions as F

from vitalgrid.operators import anomaly, clean, missing
from vitalgrid.plans.series import Series
from vitalgrid.queries.registry import R, query

# times from 2004 for one event type, none for another
TIMES = """
    SELECT event_id, user_id, event_type, value,
           CASE event_type WHEN 'view' THEN ts - INTERVAL 20 YEAR WHEN 'error' THEN NULL ELSE ts END AS ts
    FROM events
"""


def times(t):
    ts = F.when(F.col("event_type") == "view", F.expr("ts - INTERVAL 20 YEARS")).when(
        F.col("event_type") != "error", F.col("ts")
    )
    return t.events.select("event_id", "user_id", "event_type", "value", ts.alias("ts"))


AS_OF = "2024-01-20 00:00:00"


@query(
    "f1_future_timestamps",
    f"""
    SELECT user_id, count(*) AS rows, count(*) FILTER (ts > TIMESTAMP '{AS_OF}') AS future_timestamps
    FROM ({TIMES}) GROUP BY user_id
    """,
)
def _(t):
    return clean.timestamp_report(times(t), ["user_id"], "ts", AS_OF).select("user_id", "rows", "future_timestamps")


@query(
    "f2_old_timestamps",
    f"""
    SELECT event_id, user_id, ts FROM ({TIMES})
    WHERE ts >= TIMESTAMP '2010-01-01' AND ts <= TIMESTAMP '{AS_OF}'
    """,
)
def _(t):
    return clean.drop_bad_timestamps(times(t), "ts", AS_OF).select("event_id", "user_id", "ts")


@query(
    "f3_unparsed_timestamps",
    f"""
    SELECT user_id, count(*) FILTER (ts IS NULL) AS invalid_timestamps,
           {R("round_even((100.0 * count(*) FILTER (ts IS NULL) / count(*))::decimal(28, 10), 1)")} AS invalid_percentage
    FROM ({TIMES}) GROUP BY user_id
    """,
)
def _(t):
    report = clean.timestamp_report(times(t), ["user_id"], "ts", AS_OF)
    return report.select("user_id", "invalid_timestamps", "invalid_percentage")


@query(
    "f4_clip_ranges",
    f"""
    SELECT event_id, {R("CASE WHEN v < 30 THEN 30 WHEN v > 220 THEN 220 ELSE v END")} AS heart_rate,
           (v < 30 OR v > 220) IS TRUE AS was_out
    FROM (SELECT event_id, CASE WHEN event_type <> 'signup' THEN value END AS v FROM events)
    """,
)
def _(t):
    df = t.events.select("event_id", F.when(F.col("event_type") != "signup", F.col("value")).alias("heart_rate"))
    return clean.clip_ranges(df.withColumn("was_out", clean.out_of_range("heart_rate")))


@query(
    "f5_row_guards",
    """
    WITH known AS (SELECT user_id, event_id FROM events WHERE event_type = 'purchase')
    SELECT user_id, event_id FROM known
    WHERE user_id IN (SELECT user_id FROM known GROUP BY user_id HAVING count(*) >= 10)
    """,
)
def _(t):
    df = t.events.select("user_id", "event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("v"))
    return clean.with_enough_rows(df, ["user_id"], 10, "v").select("user_id", "event_id")


@query(
    "f6_split_by_flags",
    """
    SELECT 'normal' AS part, count(*) AS rows FROM events WHERE value BETWEEN 1 AND 100
    UNION ALL SELECT 'violating', count(*) FROM events WHERE value < 1 OR value > 100
    UNION ALL SELECT 'sustained', count(*) FROM events WHERE value < 1 OR value > 100
    """,
)
def _(t):
    flagged = anomaly.flag_thresholds(t.events, ["user_id"], "sleep", ["ts", "event_id"], "value", (1, 100, 0))
    parts = anomaly.split_by_flags(flagged)
    rows = [df.agg(F.lit(name).alias("part"), F.count("*").alias("rows")) for name, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# missing values --------------------------------------------------------------------------------

GAPPY = """
    SELECT user_id, event_id, ts, event_type, CASE WHEN event_type = 'purchase' THEN value END AS v,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p
    FROM events
"""

AROUND = f"""
    SELECT *, last_value(v IGNORE NULLS) OVER before AS pv,
           last_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER before AS pp,
           last_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER before AS pt,
           first_value(v IGNORE NULLS) OVER after AS nv,
           first_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER after AS np,
           first_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER after AS nt
    FROM ({GAPPY})
    WINDOW before AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           after AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
"""

LINE = "CASE WHEN p - pp <= 10 THEN CASE WHEN nv IS NULL THEN pv WHEN np = pp THEN pv ELSE pv + (nv - pv) * ((p - pp)::double / (np - pp)) END END"


def gappy(t):
    return t.events.select(
        "user_id", "event_id", "ts", "event_type", F.when(F.col("event_type") == "purchase", F.col("value")).alias("v")
    )


def ordered(t):
    return Series.of(gappy(t), ["user_id"], ["ts", "event_id"])


@query("m1_interpolate", f"SELECT event_id, {R(f'coalesce(v, {LINE})')} AS v FROM ({AROUND})")
def _(t):
    return missing.interpolate_rows(ordered(t), ["v"], backfill=0).done().select("event_id", "v")


@query(
    "m2_interpolate_backfill",
    f"SELECT event_id, {R(f'coalesce(v, {LINE}, CASE WHEN np - p <= 5 THEN nv END)')} AS v FROM ({AROUND})",
)
def _(t):
    return missing.interpolate_rows(ordered(t), ["v"]).done().select("event_id", "v")


@query(
    "m3_forward_fill_text",
    """
    SELECT event_id, last_value(CASE WHEN event_type <> 'view' THEN event_type END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sleep_stage
    FROM events
    """,
)
def _(t):
    df = t.events.select(
        "user_id", "event_id", "ts", F.when(F.col("event_type") != "view", F.col("event_type")).alias("sleep_stage")
    )
    filled = missing.forward_fill(Series.of(df, ["user_id"], ["ts", "event_id"]), ["sleep_stage"])
    return filled.done().select("event_id", "sleep_stage")


@query(
    "m4_median_fill",
    f"""
    SELECT event_id, {R("coalesce(v, m)")} AS v FROM ({GAPPY})
    JOIN (SELECT user_id, quantile_cont(v, 0.5) AS m FROM ({GAPPY}) GROUP BY user_id) USING (user_id)
    """,
)
def _(t):
    return missing.median_fill(ordered(t), ["v"]).done().select("event_id", "v")


@query(
    "m5_mode_fill",
    """
    WITH base AS (SELECT event_id, user_id, CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events),
    best AS (
        SELECT user_id, kind FROM (
            SELECT user_id, kind, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, kind) AS place
            FROM base WHERE kind IS NOT NULL GROUP BY user_id, kind) WHERE place = 1)
    SELECT event_id, coalesce(base.kind, best.kind, 'unknown') AS kind FROM base LEFT JOIN best USING (user_id)
    """,
)
def _(t):
    df = t.events.select("event_id", "user_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"))
    return missing.mode_fill(Series.of(df, ["user_id"], ["event_id"]), ["kind"]).done().select("event_id", "kind")


WIDE = """
    SELECT user_id, event_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS heart_rate,
           CASE WHEN event_type <> 'click' THEN value END AS calories,
           CASE WHEN event_type <> 'view' THEN event_type END AS sleep_stage,
           CASE WHEN event_type IN ('error', 'click') THEN event_type END AS activity_type
    FROM events
"""


def wide(t):
    kind, value = F.col("event_type"), F.col("value")
    return t.events.select(
        "user_id",
        "event_id",
        "ts",
        F.when(kind == "purchase", value).alias("heart_rate"),
        F.when(kind != "click", value).alias("calories"),
        F.when(kind != "view", kind).alias("sleep_stage"),
        F.when(kind.isin("error", "click"), kind).alias("activity_type"),
    )


@query(
    "m6_handle_missing",
    f"""
    WITH base AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM ({WIDE})),
    around AS (
        SELECT *, last_value(heart_rate IGNORE NULLS) OVER b AS pv,
               last_value(CASE WHEN heart_rate IS NOT NULL THEN p END IGNORE NULLS) OVER b AS pp,
               first_value(heart_rate IGNORE NULLS) OVER a AS nv,
               first_value(CASE WHEN heart_rate IS NOT NULL THEN p END IGNORE NULLS) OVER a AS np,
               last_value(sleep_stage IGNORE NULLS) OVER b AS stage
        FROM base
        WINDOW b AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               a AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    medians AS (SELECT user_id, quantile_cont(calories, 0.5) AS m FROM base GROUP BY user_id),
    kinds AS (
        SELECT user_id, activity_type AS k FROM (
            SELECT user_id, activity_type,
                   row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, activity_type) AS place
            FROM base WHERE activity_type IS NOT NULL GROUP BY user_id, activity_type) WHERE place = 1)
    SELECT event_id, {R(f"coalesce(heart_rate, {LINE}, CASE WHEN np - p <= 5 THEN nv END)")} AS heart_rate,
           {R("coalesce(calories, m)")} AS calories, stage AS sleep_stage,
           coalesce(activity_type, k, 'unknown') AS activity_type
    FROM around LEFT JOIN medians USING (user_id) LEFT JOIN kinds USING (user_id)
    """,
)
def _(t):
    filled, _report = missing.handle_missing(wide(t), ["user_id"], "ts", ["ts", "event_id"])
    return filled.select("event_id", "heart_rate", "calories", "sleep_stage", "activity_type")


@query(
    "m6_missing_report",
    f"""
    WITH base AS (SELECT * FROM ({WIDE}))
    SELECT user_id, 'calories' AS "column", count(*) FILTER (calories IS NULL) AS missing_before,
           CASE WHEN count(*) FILTER (calories IS NULL) > 0 THEN 'median' END AS strategy FROM base GROUP BY user_id
    UNION ALL
    SELECT user_id, 'activity_type', count(*) FILTER (activity_type IS NULL),
           CASE WHEN count(*) FILTER (activity_type IS NULL) > 0 THEN 'mode' END FROM base GROUP BY user_id
    UNION ALL
    SELECT user_id, 'heart_rate', count(*) FILTER (heart_rate IS NULL),
           CASE WHEN count(*) FILTER (heart_rate IS NULL) > 0 THEN 'interpolation + backfill' END FROM base GROUP BY user_id
    UNION ALL
    SELECT user_id, 'sleep_stage', count(*) FILTER (sleep_stage IS NULL),
           CASE WHEN count(*) FILTER (sleep_stage IS NULL) > 0 THEN 'forward fill' END FROM base GROUP BY user_id
    UNION ALL
    SELECT user_id, 'ts', 0, NULL FROM base GROUP BY user_id
    """,
)
def _(t):
    _filled, report = missing.handle_missing(wide(t), ["user_id"], "ts", ["ts", "event_id"])
    return report.drop("missing_after")


@query(
    "m7_interpolate_time",
    f"""
    SELECT event_id, {R("CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv "
    "ELSE pv + (nv - pv) * ((epoch_us(ts) - epoch_us(pt))::double / (epoch_us(nt) - epoch_us(pt))) END")} AS v
    FROM ({AROUND})
    """,
)
def _(t):
    return missing.interpolate_time(ordered(t), ["v"], "ts").done().select("event_id", "v")


@query("m8_forward_fill", f"SELECT event_id, {R('pv')} AS v FROM ({AROUND})")
def _(t):
    return missing.forward_fill(ordered(t), ["v"]).done().select("event_id", "v")


@query("m9_backward_fill", f"SELECT event_id, {R('nv')} AS v FROM ({AROUND})")
def _(t):
    return missing.backward_fill(ordered(t), ["v"]).done().select("event_id", "v")


@query(
    "m10_zero_fill",
    f"SELECT event_id, {R('coalesce(v, 0)')} AS v, coalesce(v > 100, false) AS high, nullif(event_type, 'view') AS kind FROM ({GAPPY})",
)
def _(t):
    df = gappy(t).select(
        "event_id", "v", (F.col("v") > 100).alias("high"), F.nullif("event_type", F.lit("view")).alias("kind")
    )
    return missing.zero_fill(df)


# duplicates ------------------------------------------------------------------------------------


@query(
    "d1_drop_duplicate_times",
    f"""
    SELECT user_id, hour, event_id, event_type, {R('value')} AS value FROM (
        SELECT *, date_trunc('hour', ts) AS hour,
               row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) AS place
        FROM events) WHERE place = 1
    """,
)
def _(t):
    df = t.events.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_id", "event_type", "value")
    return clean.drop_duplicate_times(df, ["user_id"], "hour", ["event_id"])


@query(
    "d1_duplicate_time_report",
    """
    SELECT user_id, count(*) AS rows, count(*) - count(DISTINCT date_trunc('hour', ts)) AS duplicates_removed
    FROM events GROUP BY user_id
    """,
)
def _(t):
    df = t.events.select("user_id", F.date_trunc("hour", "ts").alias("hour"))
    return clean.duplicate_time_report(df, ["user_id"], "hour")


@query(
    "d2_duplicate_rows",
    """
    SELECT sum(n)::bigint AS total_rows, sum(n - 1)::bigint AS duplicate_rows FROM (
        SELECT count(*) AS n FROM lineitem
        GROUP BY l_returnflag, l_linestatus, CASE WHEN l_linenumber > 3 THEN l_quantity END, l_shipdate)
    """,
)
def _(t):
    part = t.lineitem.select(
        "l_returnflag", "l_linestatus", F.when(F.col("l_linenumber") > 3, F.col("l_quantity")).alias("q"), "l_shipdate"
    )
    return clean.duplicate_rows(part)


@query(
    "d3_distinct_counts",
    """
    SELECT count(DISTINCT o_custkey) AS o_custkey, count(DISTINCT o_orderstatus) AS o_orderstatus,
           count(DISTINCT o_totalprice) AS o_totalprice, count(DISTINCT o_orderdate) AS o_orderdate,
           count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS late_priority
    FROM orders
    """,
)
def _(t):
    late = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("late_priority")
    df = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", late)
    return clean.distinct_counts(df)
