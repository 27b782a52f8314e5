"""Outlier flags, quality scores, profiles."""

from pyspark.sql import functions as F

from vitalgrid.operators import quality
from vitalgrid.plans import stages
from vitalgrid.queries.registry import R, query

BOUNDS = """
    SELECT l_returnflag,
           q1q - 1.5::double * (q3q - q1q) AS q_lower, q3q + 1.5::double * (q3q - q1q) AS q_upper,
           q1p - 1.5::double * (q3p - q1p) AS p_lower, q3p + 1.5::double * (q3p - q1p) AS p_upper
    FROM (SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS q1q, quantile_cont(l_quantity, 0.75) AS q3q,
                 quantile_cont(l_extendedprice, 0.25) AS q1p, quantile_cont(l_extendedprice, 0.75) AS q3p
          FROM lineitem GROUP BY l_returnflag)
"""


def lines(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")


@query(
    "q1_iqr_outliers",
    f"""
    SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_returnflag, l_quantity, l_extendedprice,
           l_quantity < q_lower OR l_quantity > q_upper AS l_quantity_is_outlier,
           l_extendedprice < p_lower OR l_extendedprice > p_upper AS l_extendedprice_is_outlier
    FROM lineitem JOIN ({BOUNDS}) USING (l_returnflag)
    """,
)
def _(t):
    flagged, _report = quality.flag_outliers(lines(t), ["l_returnflag"], ["l_quantity", "l_extendedprice"])
    return flagged


USER_BOUNDS = """
    SELECT user_id, q1 - 1.5::double * (q3 - q1) AS lower, q3 + 1.5::double * (q3 - q1) AS upper
    FROM (SELECT user_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY user_id)
"""


@query(
    "q1_outlier_report",
    f"""
    SELECT user_id, 'value' AS "column", count(*) FILTER (value < lower OR value > upper) AS outliers,
           {R("round_even((100 * (count(*) FILTER (value < lower OR value > upper))::double / count(*))::decimal(28, 10), 2)")} AS percentage,
           {R("any_value(lower)")} AS lower, {R("any_value(upper)")} AS upper
    FROM events JOIN ({USER_BOUNDS}) USING (user_id) GROUP BY user_id
    """,
)
def _(t):
    _flagged, report = quality.flag_outliers(t.events.select("user_id", "value"), ["user_id"])
    return report


NULLABLE = "SELECT user_id, ts, value, CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events"


def nullable(t):
    return t.events.select(
        "user_id", "ts", "value", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind")
    )


@query(
    "q2_validation_score",
    f"""
    WITH f AS (SELECT n.*, value < lower OR value > upper AS out FROM ({NULLABLE}) n JOIN ({USER_BOUNDS}) USING (user_id)),
    i AS (SELECT user_id, (max(ts) > TIMESTAMP '2024-01-30 12:00:00')::int + (max(value) > 220)::int AS issues
          FROM events GROUP BY user_id)
    SELECT user_id, count(*) AS rows, any_value(issues)::bigint AS issues,
           {R('''round_even((100::double * ((1 - count(*) FILTER (kind IS NULL)::double / (count(*) * 4)) * 0.4::double
             + greatest(0::double, 0.3::double - least(any_value(issues) * 0.05::double, 0.3::double))
             + (1 - count(*) FILTER (out)::double / count(*)) * 0.3::double))::decimal(28, 10), 2)''')} AS quality_score
    FROM f JOIN i USING (user_id) GROUP BY user_id
    """,
)
def _(t):
    df = nullable(t)
    flagged, _report = quality.flag_outliers(df, ["user_id"], ["value"])
    issues = df.groupBy("user_id").agg(
        (
            (F.max("ts") > F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")).cast("int")
            + (F.max("value") > 220).cast("int")
        ).alias("issues")
    )
    return quality.quality_scores(flagged, ["user_id"], issues)


@query(
    "q3_data_quality_score",
    f"""
    WITH base AS (SELECT user_id, date_trunc('day', ts) AS day, kind, CASE WHEN value > 50 THEN 50::double ELSE round(value, 0) END AS v
                  FROM ({NULLABLE})),
    dup AS (SELECT user_id, sum(n)::bigint AS rows, sum(n - 1)::bigint AS dups FROM
            (SELECT user_id, count(*) AS n FROM base GROUP BY user_id, day, kind, v) GROUP BY user_id),
    q AS (SELECT user_id, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM base GROUP BY user_id),
    facts AS (SELECT user_id, count(*) FILTER (kind IS NULL) AS nulls,
                     count(*) FILTER (v < q1 - 1.5::double * (q3 - q1) OR v > q3 + 1.5::double * (q3 - q1)) AS outs
              FROM base JOIN q USING (user_id) GROUP BY user_id)
    SELECT user_id, {R('''round_even(((1 - nulls::double / (rows * 3)) * 40 + (1 - dups::double / rows) * 30
                       + (1 - outs::double / rows) * 30)::decimal(28, 10), 2)''')} AS quality_score
    FROM dup JOIN facts USING (user_id)
    """,
)
def _(t):
    df = nullable(t).select(
        "user_id",
        F.date_trunc("day", "ts").alias("day"),
        "kind",
        F.when(F.col("value") > 50, F.lit(50.0)).otherwise(F.round("value", 0)).alias("v"),
    )
    return quality.data_quality_score(df, ["user_id"])


@query(
    "q4_quick_check",
    """
    WITH base AS (SELECT l_returnflag, CASE WHEN l_linenumber > 4 THEN l_quantity END AS q, l_shipdate AS date FROM lineitem),
    c AS (SELECT count(*) AS n FROM base GROUP BY ALL)
    SELECT true AS is_valid, '' AS issues,
           'Total missing values: ' || (SELECT count(*) FROM base WHERE q IS NULL) || '; Found '
             || (SELECT sum(n - 1)::bigint FROM (SELECT count(*) AS n FROM base GROUP BY l_returnflag, q, date)) || ' duplicate rows' AS warnings,
           (SELECT count(*) FROM base) AS total_rows, 3::bigint AS total_columns,
           (SELECT count(*) FROM base WHERE q IS NULL) AS missing_values,
           (SELECT sum(n - 1)::bigint FROM (SELECT count(*) AS n FROM base GROUP BY l_returnflag, q, date)) AS duplicate_rows,
           1::bigint AS numeric_columns
    """,
)
def _(t):
    df = t.lineitem.select(
        "l_returnflag", F.when(F.col("l_linenumber") > 4, F.col("l_quantity")).alias("q"), F.col("l_shipdate").alias("date")
    )
    return quality.quick_check(df).withColumns(
        {"issues": F.array_join("issues", "; "), "warnings": F.array_join("warnings", "; ")}
    )


@query(
    "q5_quality_report",
    f"""
    WITH base AS (SELECT o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
                         o_totalprice, o_orderdate FROM orders),
    q AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3
          FROM base GROUP BY o_orderstatus),
    d AS (SELECT o_orderstatus, sum(n - 1)::bigint AS dups FROM (SELECT o_orderstatus, count(*) AS n FROM base
          GROUP BY o_orderstatus, priority, o_totalprice, o_orderdate) GROUP BY o_orderstatus)
    SELECT o_orderstatus, count(*) FILTER (priority IS NULL) AS total_missing,
           {R("round_even((100 * (count(*) FILTER (priority IS NULL))::double / (count(*) * 3))::decimal(28, 10), 2)")} AS missing_percentage,
           any_value(dups) AS duplicate_rows,
           count(*) FILTER (o_totalprice < q1 - 1.5::double * (q3 - q1) OR o_totalprice > q3 + 1.5::double * (q3 - q1)) AS total_outliers,
           count(*) FILTER (o_orderdate > TIMESTAMP '2000-01-01') AS future_dates,
           count(*) FILTER (o_orderdate < TIMESTAMP '2010-01-01') AS very_old_dates,
           min(o_orderdate) AS first, max(o_orderdate) AS last
    FROM base JOIN q USING (o_orderstatus) JOIN d USING (o_orderstatus) GROUP BY o_orderstatus
    """,
)
def _(t):
    df = t.orders.select(
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        "o_totalprice",
        "o_orderdate",
    )
    report = quality.quality_report(df, ["o_orderstatus"], as_of="2000-01-01 00:00:00")
    return report.select(
        "o_orderstatus",
        "completeness.total_missing",
        "completeness.missing_percentage",
        "consistency.duplicate_rows",
        "accuracy.total_outliers",
        "timeliness.future_dates",
        "timeliness.very_old_dates",
        "timeliness.first",
        "timeliness.last",
    )


def _profile_sql(table: str, columns: dict[str, str], order: str) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", '{kind}' AS type, count({c}) AS non_null, count(*) - count({c}) AS nulls,
               {R(f"100::double * count({c}) / count(*)")} AS completeness_pct,
               count(DISTINCT {c}) AS unique_values,
               {R(f"100::double * count(DISTINCT {c}) / count(*)")} AS uniqueness_pct,
               arg_min({c}::varchar, {order}) AS sample
        FROM {table}"""
        for c, kind in columns.items()
    )


PART = {
    "p_partkey": "bigint",
    "p_name": "string",
    "p_brand": "string",
    "p_type": "string",
    "p_size": "int",
    "p_retailprice": "double",
}


@query("q6_column_profile", _profile_sql("part", PART, "p_partkey"))
def _(t):
    return quality.column_profile(t.part, ["p_partkey"])


@query(
    "q7_average_completeness",
    f"""
    SELECT {R("(100::double * count(*) / count(*) + 100::double * count(ts) / count(*) + 100::double * count(value) / count(*) + 100::double * count(kind) / count(*)) / 4")}
           AS avg_completeness FROM ({NULLABLE})
    """,
)
def _(t):
    return quality.average_completeness(quality.column_profile(nullable(t), ["ts"]))


MESSY = """
    SELECT user_id, event_id,
           CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN date_trunc('day', ts) ELSE ts END AS timestamp,
           CASE WHEN event_type <> 'view' THEN value END AS heart_rate
    FROM events
"""


def messy(t):
    kind = F.col("event_type")
    ts = F.when(kind == "signup", F.date_trunc("day", "ts").cast("timestamp_ntz")).when(kind != "error", F.col("ts"))
    return t.events.select(
        "user_id", "event_id", ts.alias("timestamp"), F.when(kind != "view", F.col("value")).alias("heart_rate")
    )


AS_OF = "2024-01-28 00:00:00"

VALIDATED = f"""
    WITH raw AS (SELECT * FROM ({MESSY}) WHERE timestamp IS NULL OR timestamp <= TIMESTAMP '{AS_OF}'),
    clipped AS (SELECT user_id, event_id, timestamp, CASE WHEN heart_rate < 30 THEN 30 WHEN heart_rate > 220 THEN 220 ELSE heart_rate END AS v,
                       row_number() OVER (PARTITION BY user_id ORDER BY timestamp, event_id) AS p
                FROM raw WHERE timestamp IS NOT NULL),
    around AS (
        SELECT *, last_value(v IGNORE NULLS) OVER b AS pv,
               last_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER b AS pp,
               first_value(v IGNORE NULLS) OVER a AS nv,
               first_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER a AS np
        FROM clipped
        WINDOW b AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               a AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    filled AS (
        SELECT user_id, event_id, timestamp, coalesce(v,
               CASE WHEN p - pp <= 10 THEN CASE WHEN nv IS NULL THEN pv WHEN np = pp THEN pv
                    ELSE pv + (nv - pv) * ((p - pp)::double / (np - pp)) END END,
               CASE WHEN np - p <= 5 THEN nv END) AS heart_rate FROM around),
    bounds AS (SELECT user_id, q1 - 1.5::double * (q3 - q1) AS lower, q3 + 1.5::double * (q3 - q1) AS upper FROM (
        SELECT user_id, quantile_cont(heart_rate, 0.25) AS q1, quantile_cont(heart_rate, 0.75) AS q3 FROM filled GROUP BY user_id)),
    flagged AS (SELECT filled.*, heart_rate < lower OR heart_rate > upper AS heart_rate_is_outlier
                FROM filled JOIN bounds USING (user_id)),
    uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, timestamp ORDER BY event_id) AS place FROM flagged)
             WHERE place = 1)
"""


@query(
    "q8_validate_rows",
    f"{VALIDATED} SELECT user_id, event_id, timestamp, {R('heart_rate')} AS heart_rate, heart_rate_is_outlier FROM uniq",
)
def _(t):
    checked = stages.validate(messy(t), ["user_id"], "timestamp", ["timestamp", "event_id"], AS_OF)
    return checked.data.select("user_id", "event_id", "timestamp", "heart_rate", "heart_rate_is_outlier")


@query(
    "q8_validation_report",
    f"""
    {VALIDATED},
    found AS (SELECT user_id, count(*) AS original_rows, count(*) FILTER (timestamp IS NULL) AS invalid_timestamps,
                     count(*) FILTER (timestamp > TIMESTAMP '{AS_OF}') AS future_timestamps,
                     count(*) FILTER ((timestamp IS NULL OR timestamp <= TIMESTAMP '{AS_OF}')
                                      AND (heart_rate < 30 OR heart_rate > 220)) AS heart_rate_out_of_range
              FROM ({MESSY}) GROUP BY user_id),
    issue AS (SELECT *, ((invalid_timestamps > 0)::int + (future_timestamps > 0)::int + (heart_rate_out_of_range > 0)::int)::bigint AS issues FROM found),
    final AS (SELECT user_id, count(*) AS final_rows, count(*) FILTER (heart_rate IS NULL) AS nulls,
                     count(*) FILTER (heart_rate_is_outlier) AS outs FROM uniq GROUP BY user_id),
    before AS (SELECT user_id, count(*) AS n FROM flagged GROUP BY user_id)
    SELECT user_id, original_rows, invalid_timestamps, future_timestamps, heart_rate_out_of_range, issues, final_rows,
           n - final_rows AS duplicates_removed, original_rows - final_rows AS rows_removed,
           {R('''round_even((100::double * ((1 - nulls::double / (final_rows * 3)) * 0.4::double
             + greatest(0::double, 0.3::double - least(issues * 0.05::double, 0.3::double))
             + (1 - outs::double / final_rows) * 0.3::double))::decimal(28, 10), 2)''')} AS quality_score
    FROM issue JOIN final USING (user_id) JOIN before USING (user_id)
    """,
)
def _(t):
    checked = stages.validate(messy(t), ["user_id"], "timestamp", ["timestamp", "event_id"], AS_OF)
    return checked.reports["validation"].drop("old_timestamps", "issue_list")
