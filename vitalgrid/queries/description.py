"""Coverage, statistics, trends, extrema, findings, histograms."""

from pyspark.sql import functions as F

from vitalgrid.operators import describe, zones
from vitalgrid.queries.registry import R, query

HOUR_COUNTS = ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS h{h:02d}" for h in range(24))


@query("a1_hourly_counts", "SELECT event_type, hour(ts) AS hour, count(*) AS records FROM events GROUP BY event_type, hour(ts)")
def _(t):
    return describe.hourly_counts(t.events, ["event_type"], "ts")


@query("a2_weekday_hour_coverage", f"SELECT dayname(ts) AS day_of_week, {HOUR_COUNTS} FROM events GROUP BY dayname(ts)")
def _(t):
    return describe.weekday_hour_coverage(t.events, "ts")


@query("a3_date_hour_coverage", f"SELECT ts::date AS date, {HOUR_COUNTS} FROM events GROUP BY ts::date")
def _(t):
    return describe.date_hour_coverage(t.events, "ts")


@query(
    "a4_hour_comparison",
    """
    SELECT event_id, hour(ts) AS hour_before, hour((ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC') AS hour_after
    FROM events ORDER BY event_id LIMIT 100
    """,
)
def _(t):
    df = t.events.select("event_id", "ts").withColumn("utc", zones.to_utc(F.col("ts").cast("timestamp"), F.lit("America/New_York")))
    return describe.hour_comparison(df, "ts", "utc", ["event_id"])


def _stat_rows(columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT upper(l_returnflag) AS dataset, count(*) AS records, '{label}' AS metric, {R(f'avg({c})')} AS mean,
               {R(f'quantile_cont({c}, 0.5)')} AS median, {R(f'stddev_samp({c})')} AS std, {R(f'min({c})')} AS min, {R(f'max({c})')} AS max
        FROM lineitem GROUP BY l_returnflag"""
        for c, label in columns.items()
    )


@query(
    "a5_long_statistics",
    _stat_rows({"l_quantity": "L Quantity", "l_extendedprice": "L Extendedprice", "l_discount": "L Discount"}),
)
def _(t):
    return describe.long_statistics(t.lineitem, "l_returnflag", ["l_quantity", "l_extendedprice", "l_discount"])


def _wide_rows() -> str:
    stats = {
        "Mean": "avg(v)",
        "Median": "quantile_cont(v, 0.5)",
        "Std Deviation": "stddev_samp(v)",
        "Minimum": "min(v)",
        "Maximum": "max(v)",
        "Variance": "var_samp(v)",
    }
    types = {"'click', 'signup'": "Steps", "'view', 'error'": "Heart Rate", "'purchase'": "Sleep"}

    def cell(e: str, kind: str, name: str) -> str:
        of_kind = e.replace("(v", f"(CASE WHEN event_type IN ({kind}) THEN value / 3 END")
        return R(f"round_even(({of_kind})::decimal(28, 10), 2)") + f' AS "{name}"'

    return " UNION ALL ".join(
        f"SELECT '{n}' AS statistic, " + ", ".join(cell(e, k, v) for k, v in types.items()) + " FROM events"
        for n, e in stats.items()
    )


@query("a6_compare_datasets", _wide_rows())
def _(t):
    value = F.col("value") / 3
    return describe.compare_datasets(
        {
            "steps": t.events.filter("event_type in ('click', 'signup')").select(value.alias("step_count")),
            "heart_rate": t.events.filter("event_type in ('view', 'error')").select(value.alias("heart_rate")),
            "sleep": t.events.filter("event_type = 'purchase'").select(value.alias("duration_minutes")),
        }
    )


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "late_tax", "one"]


@query(
    "a7_correlations",
    "WITH base AS (SELECT l_quantity, l_extendedprice, l_discount, CASE WHEN l_linenumber > 2 THEN l_tax END AS late_tax, 1::double AS one FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + ("max(NULL::double)" if "one" in (a, b) else R(f"corr({a}, {b})"))
        + " AS correlation FROM base"
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def _(t):
    df = t.lineitem.select(
        "l_quantity", "l_extendedprice", "l_discount", F.when(F.col("l_linenumber") > 2, F.col("l_tax")).alias("late_tax"), F.lit(1.0).alias("one")
    )
    return describe.correlations(df)


@query(
    "a8_zscore",
    f"""
    SELECT event_id, coalesce(abs(value - m) / nullif(s, 0) > 3, false) AS value_anomaly_zscore
    FROM events JOIN (SELECT user_id, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY user_id) USING (user_id)
    """,
)
def _(t):
    return describe.flag_zscore(t.events, ["user_id"], "value").select("event_id", "value_anomaly_zscore")


# whole numbers, so that the prominence test has no rounding
RUNS = """
    WITH s AS (SELECT user_id, round(value, 0) AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p FROM events),
    c AS (SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY p) AS before FROM s),
    r AS (SELECT user_id, v, p FROM c WHERE before IS NULL OR before <> v),
    e AS (SELECT *, lag(v) OVER w AS pv, lead(v) OVER w AS nv, lead(p) OVER w AS np, row_number() OVER w AS i FROM r WINDOW w AS (PARTITION BY user_id ORDER BY p)),
    t AS (SELECT *, CASE WHEN pv < v AND nv < v THEN 'peak' WHEN pv > v AND nv > v THEN 'valley' END AS kind FROM e),
    k AS (SELECT user_id, i, kind, (p + np - 1) // 2 AS pos, CASE kind WHEN 'peak' THEN v ELSE -v END AS h, v AS value FROM t WHERE kind IS NOT NULL),
    x AS (
        SELECT k.*,
               max(o.i) FILTER (o.i < k.i AND CASE k.kind WHEN 'peak' THEN o.v ELSE -o.v END > k.h) AS higher_left,
               min(o.i) FILTER (o.i > k.i AND CASE k.kind WHEN 'peak' THEN o.v ELSE -o.v END > k.h) AS higher_right
        FROM k JOIN t o USING (user_id) GROUP BY ALL),
    y AS (
        SELECT x.user_id, x.i, x.kind, x.pos, x.value, x.h,
               min(CASE x.kind WHEN 'peak' THEN o.v ELSE -o.v END) FILTER (o.i <= x.i AND o.i > coalesce(higher_left, 0)) AS low_left,
               min(CASE x.kind WHEN 'peak' THEN o.v ELSE -o.v END) FILTER (o.i >= x.i AND o.i < coalesce(higher_right, 1000000000)) AS low_right
        FROM x JOIN t o USING (user_id) GROUP BY ALL),
    f AS (SELECT * FROM y WHERE h - greatest(low_left, low_right) >= 1)
"""


def rounded(t):
    return t.events.select("user_id", "ts", "event_id", F.round("value", 0).alias("v"))


@query("a9_extrema", f"{RUNS} SELECT user_id, pos, {R('value')} AS value, kind FROM f")
def _(t):
    return describe.extrema(rounded(t), ["user_id"], "v", ["ts", "event_id"])


@query(
    "a9_extrema_summary",
    f"""
    {RUNS}
    SELECT user_id, count(*) FILTER (kind = 'peak') AS peak_count, {R("coalesce(avg(value) FILTER (kind = 'peak'), 0)")} AS avg_peak_value,
           count(*) FILTER (kind = 'valley') AS valley_count, {R("coalesce(avg(value) FILTER (kind = 'valley'), 0)")} AS avg_valley_value
    FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN f USING (user_id) GROUP BY user_id
    """,
)
def _(t):
    return describe.extrema_summary(rounded(t), ["user_id"], "v", ["ts", "event_id"])


TREND = """
    SELECT user_id, count(*) AS points, regr_slope(value, p) AS slope, regr_r2(value, p) AS r_squared FROM (
        SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::double AS p
        FROM events WHERE event_type <> 'error') GROUP BY user_id HAVING count(*) >= 2
"""


def partly(t):
    return t.events.select("user_id", "ts", "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))


@query(
    "a10_trend",
    f"""
    SELECT user_id, points, {R('slope')} AS slope, {R('r_squared')} AS r_squared,
           CASE WHEN slope > 0 THEN 'increasing' ELSE 'decreasing' END AS trend FROM ({TREND})
    """,
)
def _(t):
    return describe.trends(partly(t), ["user_id"], "v", ["ts", "event_id"]).drop("p_value", "is_significant")


# the two-sided t probability for whole degrees of freedom is a finite sum; the angle's sine is |r|
SIGNIFICANCE = f"""
    WITH f AS (SELECT *, points - 2 AS nu, sqrt(least(r_squared, 1)) AS si, sqrt(greatest(1 - r_squared, 0)) AS co FROM ({TREND})),
    terms AS (SELECT user_id, unnest(generate_series(0, CASE WHEN nu % 2 = 0 THEN (nu - 2) // 2 ELSE (nu - 3) // 2 END)) AS k FROM f WHERE nu >= 2),
    sums AS (SELECT user_id, sum(CASE WHEN nu % 2 = 0 THEN exp(lgamma(2 * k + 1) - 2 * lgamma(k + 1) - 2 * k * ln(2)) * co ** (2 * k)
                                 ELSE exp(2 * k * ln(2) + 2 * lgamma(k + 1) - lgamma(2 * k + 2)) * co ** (2 * k + 1) END) AS total
             FROM terms JOIN f USING (user_id) GROUP BY user_id),
    p AS (SELECT f.*, CASE WHEN nu <= 0 THEN NULL WHEN nu % 2 = 0 THEN 1 - si * coalesce(total, 0)
                      ELSE 1 - 2 / pi() * (asin(si) + si * coalesce(total, 0)) END AS p_value FROM f LEFT JOIN sums USING (user_id))
    SELECT user_id, points, {R('slope')} AS slope, {R('r_squared')} AS r_squared, {R('p_value')} AS p_value,
           CASE WHEN slope > 0 THEN 'increasing' ELSE 'decreasing' END AS trend, p_value < 0.05 AS is_significant
    FROM p
"""


@query("a10_trend_significance", SIGNIFICANCE)
def _(t):
    return describe.trends(partly(t), ["user_id"], "v", ["ts", "event_id"])


@query(
    "a11_findings_heart_rate",
    f"""
    WITH f AS (SELECT user_id, avg(value) AS m, stddev_samp(value) AS s, max(value) AS x FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN m < 60 THEN 'hr_low' WHEN m > 100 THEN 'hr_high' ELSE 'hr_normal' END AS code, {R('m')} AS value FROM f
    UNION ALL SELECT user_id, 'hr_variable', {R('s')} FROM f WHERE s > 15
    UNION ALL SELECT user_id, 'hr_peak', {R('x')} FROM f WHERE x > 180
    """,
)
def _(t):
    df = t.events.select("user_id", F.col("value").alias("heart_rate"))
    return describe.findings(df, ["user_id"], "heart_rate").drop("finding")


@query(
    "a11_findings_steps",
    f"""
    WITH f AS (SELECT user_id, sum(trunc(value * 4)::bigint)::double AS total, avg(trunc(value * 4)::bigint) AS m FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN total >= 10000 THEN 'steps_goal' ELSE 'steps_short' END AS code, {R('total')} AS value FROM f
    UNION ALL SELECT user_id, 'steps_active', {R('m')} FROM f WHERE m > 500
    """,
)
def _(t):
    df = t.events.select("user_id", F.floor(F.col("value") * 4).cast("long").alias("step_count"))
    return describe.findings(df, ["user_id"], "steps").drop("finding")


@query(
    "a11_findings_sleep",
    f"""
    WITH f AS (SELECT user_id, sum(value) / 8 / 60 AS hours, 100::double * count(*) FILTER (event_type = 'view') / count(*) AS deep,
                      count(*) FILTER (event_type = 'view') AS n FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN hours < 7 THEN 'sleep_short' WHEN hours <= 9 THEN 'sleep_good' ELSE 'sleep_long' END AS code, {R('hours')} AS value
    FROM f WHERE hours > 0
    UNION ALL SELECT user_id, 'sleep_deep', {R('deep')} FROM f WHERE n > 0 AND deep >= 20
    """,
)
def _(t):
    stage = F.when(F.col("event_type") == "view", "deep").otherwise("light")
    df = t.events.select("user_id", stage.alias("sleep_stage"), (F.col("value") / 8).alias("duration_minutes"))
    return describe.findings(df, ["user_id"], "sleep").drop("finding")


@query(
    "a12_histogram",
    f"""
    WITH e AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY l_returnflag),
    c AS (SELECT l_returnflag, least(floor((l_extendedprice - lo) * 30 / (hi - lo)) + 1, 30)::bigint AS bin, count(*) AS n
          FROM lineitem JOIN e USING (l_returnflag) GROUP BY ALL)
    SELECT e.l_returnflag, b.bin, {R('lo + (hi - lo) * (b.bin - 1) / 30')} AS lower, {R('lo + (hi - lo) * b.bin / 30')} AS upper,
           coalesce(n, 0) AS records
    FROM e, (SELECT unnest(range(1, 31)) AS bin) b LEFT JOIN c ON c.l_returnflag = e.l_returnflag AND c.bin = b.bin
    """,
)
def _(t):
    return describe.histogram(t.lineitem, ["l_returnflag"], "l_extendedprice", 30)


BOX = """
    WITH q AS (SELECT user_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
               FROM events GROUP BY user_id)
"""
INSIDE = "value BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1)"


@query(
    "a13_box_summary",
    f"""
    {BOX}
    SELECT user_id, {R('any_value(q1)')} AS q1, {R('any_value(median)')} AS median, {R('any_value(q3)')} AS q3,
           {R(f'min(value) FILTER ({INSIDE})')} AS lower_whisker, {R(f'max(value) FILTER ({INSIDE})')} AS upper_whisker,
           {R('avg(value)')} AS mean, {R('stddev_samp(value)')} AS std, count(*) FILTER (NOT ({INSIDE})) AS outliers
    FROM events JOIN q USING (user_id) GROUP BY user_id
    """,
)
def _(t):
    return describe.box_summary(t.events, ["user_id"], "value")


@query("a13_outlier_points", f"{BOX} SELECT event_id, {R('value')} AS value FROM events JOIN q USING (user_id) WHERE NOT ({INSIDE})")
def _(t):
    return describe.outlier_points(t.events, ["user_id"], "value").select("event_id", "value")


@query(
    "a14_metric_summary",
    f"""
    {RUNS},
    b AS (SELECT user_id, count(*) AS data_points, avg(v) AS mean, quantile_cont(v, 0.5) AS median, stddev_samp(v) AS std,
                 max(v) - min(v) AS range, avg(v) AS m, stddev_pop(v) AS sp FROM s GROUP BY user_id),
    z AS (SELECT user_id, count(*) FILTER (abs(v - m) / nullif(sp, 0) > 3) AS anomalies FROM s JOIN b USING (user_id) GROUP BY user_id),
    g AS (SELECT user_id, count(*) FILTER (kind = 'peak') AS peak_count, count(*) FILTER (kind = 'valley') AS valley_count FROM f GROUP BY user_id)
    SELECT user_id, data_points, {R('mean')} AS mean, {R('median')} AS median, {R('std')} AS std, {R('range')} AS range, anomalies,
           {R('100::double * anomalies / data_points')} AS anomaly_percentage, coalesce(peak_count, 0) AS peak_count, coalesce(valley_count, 0) AS valley_count
    FROM b JOIN z USING (user_id) LEFT JOIN g USING (user_id)
    """,
)
def _(t):
    summary = describe.metric_summary(rounded(t), ["user_id"], "v", ["ts", "event_id"])
    return summary.select(
        "user_id", "data_points", "mean", "median", "std", "range", "anomalies", "anomaly_percentage", "peak_count", "valley_count"
    )
