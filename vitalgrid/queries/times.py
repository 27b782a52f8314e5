"""Frequency, resampling, alignment, time zones."""

from pyspark.sql import functions as F

from vitalgrid.operators import align, zones
from vitalgrid.queries.registry import R, query

GAPS = """
    SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1000000::double AS gap
    FROM events
"""

FREQ = f"""
    SELECT user_id, count(*) AS rows, quantile_cont(gap, 0.5) AS median_seconds FROM ({GAPS}) GROUP BY user_id
"""

NAME = """
    CASE WHEN rows < 2 THEN 'insufficient_data'
         WHEN median_seconds < 60 THEN trunc(median_seconds)::bigint || 'sec'
         WHEN median_seconds < 3600 THEN trunc(median_seconds / 60)::bigint || 'min'
         ELSE printf('%.1f', median_seconds / 3600) || 'hour' END
"""


@query(
    "t1_detect_frequency",
    f"SELECT user_id, rows, {R('median_seconds * 1000')} AS median_ms, {NAME} AS frequency FROM ({FREQ})",
)
def _(t):
    found = align.detect_frequency(t.events, ["user_id"], "ts", ["ts", "event_id"])
    return found.select("user_id", "rows", (F.col("median_seconds") * 1000).alias("median_ms"), "frequency")


MINUTES = f"""
    CASE WHEN contains(f, 'min') THEN regexp_extract(f, '(\\d+)', 1)::double
         WHEN contains(f, 'sec') THEN regexp_extract(f, '(\\d+)', 1)::double / 60
         WHEN contains(f, 'hour') THEN regexp_extract(f, '(\\d+)', 1)::double * 60 END
"""


@query(
    "t2_frequency_minutes",
    f"SELECT event_id, f AS frequency, {R(MINUTES)} AS minutes FROM (SELECT event_id, trunc(value)::bigint || CASE event_type "
    "WHEN 'click' THEN 'sec' WHEN 'view' THEN 'min' WHEN 'error' THEN '.5hour' ELSE ' beats' END AS f FROM events)",
)
def _(t):
    unit = (
        F.when(F.col("event_type") == "click", "sec")
        .when(F.col("event_type") == "view", "min")
        .when(F.col("event_type") == "error", ".5hour")
        .otherwise(" beats")
    )
    df = t.events.select("event_id", F.concat(F.floor("value").cast("string"), unit).alias("frequency"))
    return df.withColumn("minutes", align.frequency_minutes(F.col("frequency")))


@query(
    "t3_expansion_guard",
    f"""
    WITH span AS (SELECT user_id, min(ts) AS first, max(ts) AS last, (epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000::double / 120 AS expected
                  FROM events GROUP BY user_id)
    SELECT user_id, rows, {NAME} AS frequency, first, last,
           {R('expected')} AS expected_rows, NOT (rows >= 2 AND expected > rows * 5) AS resample
    FROM ({FREQ}) JOIN span USING (user_id)
    """,
)
def _(t):
    return align.expansion_guard(t.events, ["user_id"], "ts", 7200, ["ts", "event_id"]).drop("median_seconds")


SENSOR = """
    SELECT event_type, event_id, ts, value AS heart_rate, trunc(value)::bigint AS step_count,
           CASE WHEN value > 80 THEN 'deep' WHEN value > 40 THEN 'light' WHEN value > 15 THEN 'rem' END AS sleep_stage,
           CASE WHEN value > 20 THEN props END AS note, value > 200 AS heart_rate_is_outlier
    FROM events
"""


def sensor(t):
    v = F.col("value")
    return t.events.select(
        "event_type",
        "event_id",
        "ts",
        v.alias("heart_rate"),
        F.floor(v).cast("long").alias("step_count"),
        F.when(v > 80, "deep").when(v > 40, "light").when(v > 15, "rem").alias("sleep_stage"),
        F.when(v > 20, F.col("props")).alias("note"),
        (v > 200).alias("heart_rate_is_outlier"),
    )


@query(
    "t4_smart_resample",
    f"""
    WITH s AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS b FROM ({SENSOR})),
    m AS (SELECT event_type, b, sleep_stage FROM (
            SELECT event_type, b, sleep_stage, row_number() OVER (PARTITION BY event_type, b ORDER BY count(*) DESC, sleep_stage) AS place
            FROM s WHERE sleep_stage IS NOT NULL GROUP BY event_type, b, sleep_stage) WHERE place = 1)
    SELECT event_type, b AS ts, {R('avg(heart_rate)')} AS heart_rate, sum(step_count)::bigint AS step_count,
           any_value(m.sleep_stage) AS sleep_stage, arg_min(note, s.ts) FILTER (note IS NOT NULL) AS note,
           bool_or(heart_rate_is_outlier) AS heart_rate_is_outlier
    FROM s LEFT JOIN m USING (event_type, b) GROUP BY event_type, b
    """,
)
def _(t):
    return align.smart_resample(sensor(t), ["event_type"], "ts", 3600, ["ts", "event_id"], complete=False)


@query(
    "t5_resample_any_width",
    f"""
    WITH o AS (SELECT event_type, date_trunc('day', min(ts)) AS origin FROM events GROUP BY event_type),
    s AS (SELECT e.*, o.origin + to_microseconds(((epoch_us(ts) - epoch_us(origin)) // 25200000000) * 25200000000) AS b
          FROM events e JOIN o USING (event_type))
    SELECT event_type, b AS ts, {R('avg(value)')} AS mean_value, {R('sum(value)')} AS sum_value,
           {R('quantile_cont(value, 0.5)')} AS median_value, {R('arg_min(value, ts)')} AS first_value,
           {R('arg_max(value, ts)')} AS last_value
    FROM s GROUP BY event_type, b
    """,
)
def _(t):
    v = F.col("value")
    how = {"mean_value": "mean", "sum_value": "sum", "median_value": "median", "first_value": "first", "last_value": "last"}
    df = t.events.select("event_type", "event_id", "ts", *[v.alias(c) for c in how])
    return align.resample(df, ["event_type"], "ts", 7 * 3600, how, ["ts", "event_id"], complete=False)


def _grid(seconds: int) -> str:
    return f"""
    WITH s AS (SELECT event_type, time_bucket(INTERVAL {seconds} SECOND, ts) AS b, CASE WHEN gap THEN NULL ELSE trunc(value)::bigint END AS steps, CASE WHEN gap THEN NULL ELSE value END AS value
               FROM (SELECT *, event_type = 'view' AND value <= 60 AS gap FROM events)),
    a AS (SELECT event_type, b, coalesce(sum(steps), 0)::bigint AS steps, avg(value) AS value FROM s GROUP BY event_type, b),
    g AS (SELECT event_type, unnest(generate_series(min(b), max(b), INTERVAL {seconds} SECOND)) AS b FROM a GROUP BY event_type)
    """


@query(
    "t6_complete_grid",
    f"{_grid(900)} SELECT event_type, g.b AS ts, coalesce(steps, 0)::bigint AS steps, {R('value')} AS value FROM g LEFT JOIN a USING (event_type, b)",
)
def _(t):
    seen = (F.col("event_type") != "view") | (F.col("value") > 60)
    df = t.events.select(
        "event_type", "event_id", "ts", F.when(seen, F.floor("value").cast("long")).alias("steps"), F.when(seen, F.col("value")).alias("value")
    )
    return align.resample(df, ["event_type"], "ts", 900, {"steps": "sum", "value": "mean"}, ["ts", "event_id"])


@query(
    "t7_sleep_keeps_rows",
    f"SELECT user_id, o_orderdate AS ts, {R('o_totalprice')} AS duration_minutes FROM (SELECT o_custkey AS user_id, * FROM orders)",
)
def _(t):
    df = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("duration_minutes"))
    aligned, _report = align.align(df, ["user_id"], "sleep", "ts", "1 min")
    return aligned


ALIGNED = """
    WITH s AS (SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts) AS b, value FROM events),
    a AS (SELECT event_type, b, avg(value) AS v FROM s GROUP BY event_type, b),
    g AS (SELECT event_type, unnest(generate_series(min(b), max(b), INTERVAL 15 MINUTE)) AS b FROM a GROUP BY event_type),
    j AS (SELECT event_type, b, v FROM g LEFT JOIN a USING (event_type, b)),
    w AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN v IS NOT NULL THEN b END IGNORE NULLS) OVER p AS pb,
                 first_value(v IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN v IS NOT NULL THEN b END IGNORE NULLS) OVER n AS nb
          FROM j
          WINDOW p AS (PARTITION BY event_type ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 n AS (PARTITION BY event_type ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    kept AS (SELECT event_type FROM events GROUP BY event_type
             HAVING count(*) >= 2 AND (epoch_us(max(ts)) - epoch_us(min(ts))) / 900000000::double > count(*) * 5)
    SELECT event_type, b AS ts, round(CASE WHEN v IS NOT NULL THEN v
           ELSE pv + (nv - pv) * ((epoch_us(b) - epoch_us(pb))::double / (epoch_us(nb) - epoch_us(pb))) END, 6) + 0.0::double AS heart_rate
    FROM w WHERE event_type NOT IN (SELECT event_type FROM kept)
    UNION ALL
    SELECT event_type, ts, round(value, 6) + 0.0::double FROM events WHERE event_type IN (SELECT event_type FROM kept)
"""


BETWEEN = "pv + (nv - pv) * ((epoch_us(b) - epoch_us(pb))::double / (epoch_us(nb) - epoch_us(pb)))"


def filled(t, method: str):
    df = t.events.select("event_type", "event_id", "ts", F.col("value").alias("heart_rate"))
    aligned, _report = align.align(df, ["event_type"], "heart_rate", "ts", "15 min", method, ["ts", "event_id"])
    return aligned


@query("t8_align_forward", ALIGNED.replace(BETWEEN, "pv"))
def _(t):
    return filled(t, "forward_fill")


@query("t8_align_backward", ALIGNED.replace(BETWEEN, "nv"))
def _(t):
    return filled(t, "backward_fill")


@query("t8_align_zero", ALIGNED.replace(BETWEEN, "0"))
def _(t):
    return filled(t, "zero")


@query("t8_align", ALIGNED)
def _(t):
    df = t.events.select("event_type", "event_id", "ts", F.col("value").alias("heart_rate"))
    aligned, _report = align.align(df, ["event_type"], "heart_rate", "ts", "15 min", "interpolate", ["ts", "event_id"])
    return aligned


@query(
    "t8_align_report",
    f"""
    WITH s AS (SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000::double AS minutes,
                      time_bucket(INTERVAL 1 HOUR, min(ts)) AS b0, time_bucket(INTERVAL 1 HOUR, max(ts)) AS b1
               FROM events GROUP BY user_id),
    k AS (SELECT *, rows >= 2 AND minutes / 60 > rows * 5 AS kept FROM ({FREQ}) JOIN s USING (user_id))
    SELECT user_id, 'heart_rate' AS data_type, rows AS original_rows, {NAME} AS original_frequency, '1 hour' AS target_frequency,
           CASE WHEN kept THEN rows ELSE (epoch_us(b1) - epoch_us(b0)) // 3600000000 + 1 END AS resampled_rows,
           {R('''CASE WHEN kept THEN minutes / 60 ELSE (epoch_us(b1) - epoch_us(b0)) / 3600000000::double END''')} AS span_hours,
           true AS success, NULL::varchar AS error
    FROM k
    """,
)
def _(t):
    df = t.events.select("user_id", "event_id", "ts", F.col("value").alias("heart_rate"))
    _aligned, report = align.align(df, ["user_id"], "heart_rate", "ts", "1 hour", "interpolate", ["ts", "event_id"])
    return report


@query(
    "t8_align_error",
    """
    SELECT user_id, 'heart_rate' AS data_type, count(*) AS original_rows, 'unknown' AS original_frequency, '2 weeks' AS target_frequency,
           NULL::bigint AS resampled_rows, NULL::double AS span_hours, false AS success, '''2 weeks''' AS error FROM events GROUP BY user_id
    """,
)
def _(t):
    df = t.events.select("user_id", "event_id", "ts", F.col("value").alias("heart_rate"))
    _rows, report = align.align(df, ["user_id"], "heart_rate", "ts", "2 weeks")
    return report


PLACE = """
    CASE event_type WHEN 'click' THEN 'New York, NY' WHEN 'view' THEN 'Europe/Berlin' WHEN 'purchase' THEN 'central london'
                    WHEN 'signup' THEN 'Atlantis' END
"""
ZONE = """
    CASE event_type WHEN 'click' THEN 'America/New_York' WHEN 'view' THEN 'Europe/Berlin' WHEN 'purchase' THEN 'Europe/London'
                    ELSE 'UTC' END
"""


def placed(t):
    kind = F.col("event_type")
    place = (
        F.when(kind == "click", "New York, NY")
        .when(kind == "view", "Europe/Berlin")
        .when(kind == "purchase", "central london")
        .when(kind == "signup", "Atlantis")
    )
    return t.events.withColumn("place", place)


@query("t9_detect_zone", f"SELECT event_id, {PLACE} AS place, {ZONE} AS zone FROM events")
def _(t):
    return placed(t).select("event_id", "place", zones.zone_of(F.col("place")).alias("zone"))


# half past two at night falls into the skipped hour in spring, half past one into the repeated one
LOCAL = """
    SELECT o_orderkey, o_orderdate + CASE WHEN o_orderstatus = 'F' THEN INTERVAL 90 MINUTE ELSE INTERVAL 150 MINUTE END AS ts,
           CASE o_orderstatus WHEN 'O' THEN 'Europe/London' ELSE 'America/New_York' END AS zone
    FROM orders
"""


def local(t):
    late = F.when(F.col("o_orderstatus") == "F", F.expr("INTERVAL '90' MINUTE")).otherwise(F.expr("INTERVAL '150' MINUTE"))
    zone = F.when(F.col("o_orderstatus") == "O", "Europe/London").otherwise("America/New_York")
    return t.orders.select("o_orderkey", (F.col("o_orderdate") + late).alias("ts"), zone.alias("zone"))


UTC_OF = f"""
    SELECT *, CASE WHEN ((u - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE zone = ts THEN u - INTERVAL 1 HOUR ELSE u END AS utc
    FROM (SELECT *, (ts AT TIME ZONE zone) AT TIME ZONE 'UTC' AS u FROM ({LOCAL}))
"""


@query(
    "t10_normalize_to_utc",
    f"""
    SELECT o_orderkey, utc AS timestamp_utc, utc AS ts, (utc AT TIME ZONE 'UTC') AT TIME ZONE zone <> l AS nonexistent_shifted,
           ((utc + INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE zone = l AS ambiguous,
           hour(utc) AS hour_of_day, dayname(utc) AS day_of_week, utc::date AS date, isodow(utc) >= 6 AS is_weekend
    FROM (SELECT *, ts AS l FROM ({UTC_OF}))
    """,
)
def _(t):
    return zones.normalize_timestamps(local(t), "ts", F.col("zone")).drop("zone")


@query(
    "t11_daylight_saving",
    f"""
    WITH o AS (SELECT o_orderkey, u, zone, ((u AT TIME ZONE 'UTC') AT TIME ZONE zone) AS here,
                      make_timestamp(year(u), 1, 1, 0, 0, 0) AS jan, make_timestamp(year(u), 7, 1, 0, 0, 0) AS jul
               FROM (SELECT o_orderkey, o_orderdate + INTERVAL 12 HOUR AS u,
                            CASE o_orderstatus WHEN 'O' THEN 'Europe/London' WHEN 'F' THEN 'Australia/Sydney' ELSE 'Asia/Tokyo' END AS zone FROM orders)),
    h AS (SELECT o_orderkey, (epoch_us(here) - epoch_us(u)) / 3600000000::double AS now,
                 (epoch_us((jan AT TIME ZONE 'UTC') AT TIME ZONE zone) - epoch_us(jan)) / 3600000000::double AS a,
                 (epoch_us((jul AT TIME ZONE 'UTC') AT TIME ZONE zone) - epoch_us(jul)) / 3600000000::double AS b FROM o)
    SELECT o_orderkey, now - least(a, b) <> 0 AS is_dst, {R('now - least(a, b)')} AS dst_offset FROM h
    """,
)
def _(t):
    zone = F.when(F.col("o_orderstatus") == "O", "Europe/London").when(F.col("o_orderstatus") == "F", "Australia/Sydney")
    df = t.orders.select(
        "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL '12' HOUR")).alias("ts"), zone.otherwise("Asia/Tokyo").alias("zone")
    )
    return zones.mark_daylight_saving(df, "ts", F.col("zone")).select("o_orderkey", "is_dst", "dst_offset")


@query(
    "t12_unusual_gaps",
    f"""
    SELECT event_id, coalesce(gap > 2 * median_seconds, false) AS dst_transition FROM ({GAPS}) JOIN ({FREQ}) USING (user_id)
    """,
)
def _(t):
    flagged = align.flag_unusual_gaps(t.events, ["user_id"], "ts", ["ts", "event_id"])
    return flagged.select("event_id", "dst_transition")


@query(
    "t13_peak_hour",
    """
    SELECT user_id, h::bigint AS peak_hour FROM (
        SELECT user_id, hour(ts) AS h, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, hour(ts)) AS place
        FROM events GROUP BY user_id, hour(ts)) WHERE place = 1
    """,
)
def _(t):
    return zones.peak_hour(t.events, ["user_id"], "ts")


@query(
    "t14_series_extent",
    f"""
    SELECT user_id, count(*) AS rows, min(ts) AS start, max(ts) AS "end",
           {R("(epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000::double")} AS span_hours,
           ((epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000)::bigint AS span_days
    FROM events GROUP BY user_id
    """,
)
def _(t):
    return align.series_extent(t.events, ["user_id"], "ts")
