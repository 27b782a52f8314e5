"""Window features."""

from pyspark.sql import functions as F

from vitalgrid.operators import features
from vitalgrid.queries.registry import R, query

WINDOWS = """
    WITH s AS (SELECT user_id, ts, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p,
                      count(*) OVER (PARTITION BY user_id) AS n FROM events),
    z AS (SELECT *, CASE WHEN n >= 60 THEN 60 WHEN n >= 30 THEN 30 WHEN n >= 15 THEN 15 ELSE 7 END AS size FROM s WHERE n >= 10),
    y AS (SELECT *, greatest(1, size // 2) AS step FROM z),
    x AS (SELECT *, unnest(range(0, (n - size) // step + 1)) AS window_id FROM y),
    w AS (SELECT user_id, window_id, p - window_id * step AS pos, ts, v FROM x WHERE p >= window_id * step AND p < window_id * step + size),
    l AS (SELECT *, avg(v) OVER g AS mu, lead(v, 1) OVER o AS v1, lead(v, 2) OVER o AS v2
          FROM w WINDOW g AS (PARTITION BY user_id, window_id), o AS (PARTITION BY user_id, window_id ORDER BY pos))
"""


def windows(t):
    return features.to_windows(t.events, ["user_id"], "value", ["ts", "event_id"])


@query(
    "x1_window_size",
    """
    SELECT user_id, event_type, count(value) AS rows, 60::bigint AS requested_size,
           CASE WHEN count(value) >= 60 THEN 60 WHEN count(value) >= 30 THEN 30 WHEN count(value) >= 15 THEN 15
                WHEN count(value) >= 10 THEN 7 END::bigint AS window_size
    FROM events GROUP BY user_id, event_type
    """,
)
def _(t):
    return features.window_sizes(t.events, ["user_id", "event_type"], "value")


@query("x2_windows", f"{WINDOWS} SELECT user_id, window_id, pos, ts, {R('v')} AS value FROM w")
def _(t):
    return windows(t).drop("event_id")


@query(
    "x3_sleep_windows",
    f"""
    WITH d AS (SELECT user_id, ts::date AS day, sum(value) AS v FROM events GROUP BY user_id, ts::date),
    g AS (SELECT user_id, unnest(generate_series(min(day)::timestamp, max(day)::timestamp, INTERVAL 1 DAY)) AS day FROM d GROUP BY user_id),
    c AS (SELECT user_id, g.day AS ts, coalesce(v, 0) AS v, row_number() OVER (PARTITION BY user_id ORDER BY g.day) - 1 AS pos,
                 count(*) OVER (PARTITION BY user_id) AS n FROM g LEFT JOIN d ON d.user_id = g.user_id AND d.day = g.day),
    r AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
    SELECT c.user_id, 0::bigint AS window_id, pos, ts, {R('v')} AS value FROM c JOIN r USING (user_id) WHERE c.n >= 3 AND r.n >= 3
    """.replace("SELECT user_id, g.day", "SELECT g.user_id, g.day").replace("PARTITION BY user_id ORDER BY g.day", "PARTITION BY g.user_id ORDER BY g.day").replace("count(*) OVER (PARTITION BY user_id) AS n FROM g", "count(*) OVER (PARTITION BY g.user_id) AS n FROM g"),
)
def _(t):
    return features.sleep_windows(t.events, ["user_id"], "ts", "value")


N = "count(*)"
FEATURES = {
    "x4_mean": {"mean": "avg(v)"},
    "x5_median": {"median": "quantile_cont(v, 0.5)"},
    "x6_standard_deviation": {"standard_deviation": "stddev_pop(v)"},
    "x7_variance": {"variance": "var_pop(v)"},
    "x8_minimum": {"minimum": "min(v)"},
    "x9_maximum": {"maximum": "max(v)"},
    "x10_quantiles": {"quantile__q_0_25": "quantile_cont(v, 0.25)", "quantile__q_0_75": "quantile_cont(v, 0.75)"},
    "x11_skewness": {"skewness": "skewness(v)"},
    "x12_kurtosis": {"kurtosis": "kurtosis(v)"},
    "x13_abs_energy": {"abs_energy": "sum(v * v)"},
    "x14_absolute_sum_of_changes": {"absolute_sum_of_changes": "coalesce(sum(abs(v1 - v)), 0)"},
    "x15_count_above_mean": {"count_above_mean": "count(*) FILTER (v > mu)"},
    "x16_count_below_mean": {"count_below_mean": "count(*) FILTER (v < mu)"},
    "x17_linear_trend": {"linear_trend__attr_slope": "regr_slope(v, pos)"},
    "x18_autocorrelation": {
        "autocorrelation__lag_1": "sum((v - mu) * (v1 - mu)) / ((count(*) - 1) * var_pop(v))",
        "autocorrelation__lag_2": "sum((v - mu) * (v2 - mu)) / ((count(*) - 2) * var_pop(v))",
    },
    "x19_c3": {"c3__lag_1": "avg(v2 * v1 * v)"},
    "x21_minimal": {
        "sum_values": "sum(v)",
        "median": "quantile_cont(v, 0.5)",
        "mean": "avg(v)",
        "length": "count(*)",
        "standard_deviation": "stddev_pop(v)",
        "variance": "var_pop(v)",
        "root_mean_square": "sqrt(avg(v * v))",
        "maximum": "max(v)",
        "absolute_maximum": "max(abs(v))",
        "minimum": "min(v)",
    },
}


def _register(name: str, parts: dict[str, str], kind: str) -> None:
    selected = ", ".join(f"{R(sql)} AS value__{n}" for n, sql in parts.items())

    @query(name, f"{WINDOWS} SELECT user_id, window_id, {selected} FROM l GROUP BY user_id, window_id")
    def _(t):
        matrix = features.window_features(windows(t), ["user_id"], kind)
        return matrix.select("user_id", "window_id", *[f"value__{n}" for n in parts])


for _name, _parts in FEATURES.items():
    _register(_name, _parts, "minimal" if _name == "x21_minimal" else "efficient")


def _phi(m: int) -> str:
    same = " AND ".join(f"abs(a.x{i} - b.x{i}) <= r" for i in range(m))
    return f"""
    SELECT user_id, window_id, avg(ln(share)) AS phi FROM (
        SELECT a.user_id, a.window_id, a.pos, (count(*) FILTER ({same}))::double / count(*) AS share
        FROM e{m} a JOIN e{m} b ON a.user_id = b.user_id AND a.window_id = b.window_id GROUP BY a.user_id, a.window_id, a.pos)
    GROUP BY user_id, window_id"""


@query(
    "x20_approximate_entropy",
    f"""
    {WINDOWS},
    d AS (SELECT user_id, window_id, 0.2::double * stddev_pop(v) AS r FROM l GROUP BY user_id, window_id),
    e2 AS (SELECT user_id, window_id, pos, v AS x0, v1 AS x1, r FROM l JOIN d USING (user_id, window_id) WHERE v1 IS NOT NULL),
    e3 AS (SELECT user_id, window_id, pos, v AS x0, v1 AS x1, v2 AS x2, r FROM l JOIN d USING (user_id, window_id) WHERE v2 IS NOT NULL)
    SELECT user_id, window_id, {R('abs(a.phi - b.phi)')} AS value__approximate_entropy__m_2__r_0_2
    FROM ({_phi(2)}) a JOIN ({_phi(3)}) b USING (user_id, window_id)
    """.replace("abs(a.x0 - b.x0) <= r", "abs(a.x0 - b.x0) <= a.r").replace("abs(a.x1 - b.x1) <= r", "abs(a.x1 - b.x1) <= a.r").replace("abs(a.x2 - b.x2) <= r", "abs(a.x2 - b.x2) <= a.r"),
)
def _(t):
    matrix = features.window_features(windows(t), ["user_id"])
    return matrix.select("user_id", "window_id", "value__approximate_entropy__m_2__r_0_2")


EXTENDED = {
    "mean_abs_change": "avg(abs(v1 - v))",
    "mean_change": "(arg_max(v, pos) - arg_min(v, pos)) / (count(*) - 1)",
    "mean_second_derivative_central": "sum((v2 - 2 * v1 + v) / 2) / (count(*) - 2)",
    "cid_ce": "sqrt(sum((v1 - v) * (v1 - v)))",
    "first_location_of_maximum": "(min(pos) FILTER (v = hi))::double / count(*)",
    "last_location_of_maximum": "(max(pos) FILTER (v = hi) + 1)::double / count(*)",
    "first_location_of_minimum": "(min(pos) FILTER (v = lo))::double / count(*)",
    "last_location_of_minimum": "(max(pos) FILTER (v = lo) + 1)::double / count(*)",
    "longest_strike_above_mean": "max(strike_above)",
    "longest_strike_below_mean": "max(strike_below)",
    "number_crossing_m__m_0": "count(*) FILTER ((v > 0) <> (v1 > 0))",
    "variation_coefficient": "stddev_pop(v) / avg(v)",
    "range_count__min_-1__max_1": "count(*) FILTER (v >= -1 AND v < 1)",
    "value_count__value_0": "count(*) FILTER (v = 0)",
    "has_duplicate": "(count(DISTINCT v) < count(*))::int",
    "has_duplicate_max": "(count(*) FILTER (v = hi) > 1)::int",
    "has_duplicate_min": "(count(*) FILTER (v = lo) > 1)::int",
    "time_reversal_asymmetry__lag_1": "avg(v2 * v2 * v1 - v1 * v * v)",
    "large_standard_deviation__r_0_25": "(stddev_pop(v) > 0.25::double * (max(v) - min(v)))::int",
    "ratio_beyond_r_sigma__r_0_5": "count(*) FILTER (abs(v - mu) > 0.5::double * sd)::double / count(*)",
    "ratio_beyond_r_sigma__r_2": "count(*) FILTER (abs(v - mu) > 2 * sd)::double / count(*)",
    "sum_of_reoccurring_values": "sum(v / copies) FILTER (copies > 1)",
    "sum_of_reoccurring_data_points": "sum(v) FILTER (copies > 1)",
    "energy_ratio_by_chunks__num_segments_10__segment_focus_0": "sum(v * v) FILTER (chunk = 0) / sum(v * v)",
    "energy_ratio_by_chunks__num_segments_10__segment_focus_9": "sum(v * v) FILTER (chunk = 9) / sum(v * v)",
}


@query(
    "x22_extended",
    f"""
    {WINDOWS.replace("value AS v", "value / 7 AS v")},
    m AS (SELECT *, max(v) OVER g AS hi, min(v) OVER g AS lo, stddev_pop(v) OVER g AS sd, count(*) OVER (PARTITION BY user_id, window_id, v) AS copies,
                 count(*) OVER g AS n,
                 max(pos) FILTER (NOT v > mu) OVER o AS last_low, max(pos) FILTER (NOT v < mu) OVER o AS last_high
          FROM l WINDOW g AS (PARTITION BY user_id, window_id), o AS (PARTITION BY user_id, window_id ORDER BY pos)),
    k AS (SELECT *, pos - coalesce(last_low, -1) AS strike_above, pos - coalesce(last_high, -1) AS strike_below,
                 CASE WHEN pos < (n % 10) * (n // 10 + 1) THEN pos // (n // 10 + 1) ELSE (n % 10) + (pos - (n % 10) * (n // 10 + 1)) // (n // 10) END AS chunk FROM m)
    SELECT user_id, window_id, {', '.join(f'{R(f"coalesce({e}, 0)")} AS "value__{c}"' for c, e in EXTENDED.items())}
    FROM k GROUP BY user_id, window_id
    """,
)
def _(t):
    df = t.events.withColumn("value", F.col("value") / 7)
    rows = features.to_windows(df, ["user_id"], "value", ["ts", "event_id"])
    matrix = features.window_features(rows, ["user_id"], "comprehensive")
    return matrix.select("user_id", "window_id", *[f"value__{n}" for n in EXTENDED])


# infinities and gaps planted by event type
DIRTY = """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'infinity'::double WHEN 'view' THEN '-infinity'::double
                     WHEN 'error' THEN 'nan'::double ELSE value END AS v FROM events
"""


@query(
    "x23_impute",
    f"""
    WITH f AS (SELECT min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.5) AS md FROM ({DIRTY}) WHERE isfinite(v))
    SELECT event_id, {R("CASE WHEN isnan(v) THEN md WHEN v = 'infinity'::double THEN hi WHEN v = '-infinity'::double THEN lo ELSE v END")} AS value__v
    FROM ({DIRTY}), f
    """,
)
def _(t):
    kind = F.col("event_type")
    dirty = (
        F.when(kind == "click", float("inf")).when(kind == "view", float("-inf")).when(kind == "error", float("nan"))
    )
    return features.impute(t.events.select("event_id", dirty.otherwise(F.col("value")).alias("value__v")))


@query("x24_drop_constant", f"SELECT user_id, {R('avg(value)')} AS value__mean FROM events GROUP BY user_id")
def _(t):
    matrix = t.events.groupBy("user_id").agg(
        F.avg("value").alias("value__mean"), F.lit(1.0).alias("value__constant"), F.min(F.lit(3)).alias("value__three")
    )
    return features.drop_constant(matrix)


@query(
    "x25_top_features",
    "WITH m AS (SELECT "
    + ", ".join(f"l_{c}::double AS {c}" for c in ("quantity", "extendedprice", "discount", "tax"))
    + " FROM lineitem) "
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT 'value__{c}' AS feature, {R(f'var_samp({c})')} AS variance, {R(f'avg({c})')} AS mean, {R(f'stddev_samp({c})')} AS std FROM m"
        for c in ("quantity", "extendedprice", "discount", "tax")
    )
    + ") ORDER BY variance DESC LIMIT 3",
)
def _(t):
    names = ("quantity", "extendedprice", "discount", "tax")
    return features.top_features(t.lineitem.select(*[F.col(f"l_{c}").alias(f"value__{c}") for c in names]), 3)


@query(
    "x26_extract_features",
    f"""
    {WINDOWS}
    SELECT user_id, window_id, {R('avg(v)')} AS value__mean, {R('stddev_pop(v)')} AS value__standard_deviation,
           {R('coalesce(sum(abs(v1 - v)), 0)')} AS value__absolute_sum_of_changes
    FROM l GROUP BY user_id, window_id
    """,
)
def _(t):
    matrix, _report = features.extract_features(t.events, ["user_id"], "heart_rate", "value", "ts", ["ts", "event_id"])
    return matrix.select(
        "user_id", "window_id", "value__mean", "value__standard_deviation", "value__absolute_sum_of_changes"
    )


@query(
    "x26_extraction_report",
    """
    WITH s AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
    z AS (SELECT *, CASE WHEN n >= 60 THEN 60 WHEN n >= 30 THEN 30 WHEN n >= 15 THEN 15 WHEN n >= 10 THEN 7 END AS size FROM s)
    SELECT user_id, 'heart_rate' AS data_type, n AS original_rows, 60::bigint AS requested_window_size,
           coalesce(size, 60)::bigint AS window_size, CASE WHEN size IS NULL THEN 0 ELSE (n - size) // greatest(1, size // 2) + 1 END::bigint AS windows,
           size IS NOT NULL AS success, CASE WHEN size IS NULL THEN 'No data available for feature extraction' END AS error
    FROM z
    """,
)
def _(t):
    _matrix, report = features.extract_features(t.events, ["user_id"], "heart_rate", "value", "ts", ["ts", "event_id"], kind="minimal")
    return report.drop("features_extracted")
