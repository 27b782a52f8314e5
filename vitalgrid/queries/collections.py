"""The whole run over a folder of files: three data types, an unknown one, and files that cannot be used.
The files are written by Spark from the events; a person is an event type."""

from pyspark.sql import functions as F

from vitalgrid.plans import collection as plan
from vitalgrid.queries import forecasts
from vitalgrid.queries.registry import R, query
from vitalgrid.session import scratch_path
from vitalgrid.sources import collection

KEYS = ["person"]
MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MINUTES = 15


def folder(t) -> str:
    """Every data type in another format and under other column names."""
    root = scratch_path(t.spark, "collection")
    at = F.date_format("ts", MOMENT)
    of = lambda *kinds: t.events.filter(F.col("event_type").isin(*kinds))
    heart = t.events.select(at.alias("Time"), F.col("event_type").alias("Person"), F.col("value").alias("Heart Rate"))
    heart.write.option("header", True).csv(f"{root}/heart.csv")
    steps = of("click", "view").select(at.alias("timestamp"), F.col("event_type").alias("person"), F.floor(F.col("value") * 40).alias("Step-Count"))
    steps.write.json(f"{root}/steps.jsonl")
    sleep = of("signup").select(F.col("ts").alias("date"), F.col("event_type").alias("person"), (F.col("value") * 10).alias("duration_minutes"))
    sleep.write.parquet(f"{root}/sleep_log.parquet")
    score = F.when(F.col("event_id") % 10 == 0, F.lit("low")).otherwise(F.col("value").cast("string"))
    notes = of("error").select(at.alias("timestamp"), F.col("event_type").alias("person"), score.alias("confidence"))
    notes.write.option("header", True).csv(f"{root}/notes.csv")
    heart.drop("Heart Rate").write.option("header", True).csv(f"{root}/pulse.csv")
    t.events.agg(F.concat(F.lit('{"rows": '), F.count("*")).alias("value")).write.text(f"{root}/hr_broken.json")
    t.events.agg(F.concat(F.lit("rows "), F.count("*")).alias("value")).write.text(f"{root}/bed_broken.parquet")
    t.events.agg(F.concat(F.lit("<rows>"), F.count("*")).alias("value")).write.text(f"{root}/walk.xml")
    return root


def loaded(t) -> collection.Loaded:
    return collection.load(t.spark, folder(t), KEYS)


FILES = """
    SELECT 'heart.csv' AS file_name, 'csv' AS format, 'heart_rate' AS data_type, count(*) AS rows, 0::bigint AS rescued, 0::bigint AS unparsed,
           'heart_rate' AS metrics, true AS success, NULL::varchar AS error FROM events
    UNION ALL SELECT 'steps.jsonl', 'lines', 'steps', count(*), 0, 0, 'step_count', true, NULL FROM events WHERE event_type IN ('click', 'view')
    UNION ALL SELECT 'sleep_log.parquet', 'parquet', 'sleep', count(*), 0, 0, 'duration_minutes', true, NULL FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'notes.csv', 'csv', 'unknown', count(*), 0, count(*) FILTER (event_id % 10 = 0), 'confidence', true, NULL FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'pulse.csv', 'csv', 'heart_rate', count(*), 0, 0, '', false, 'missing columns: heart_rate' FROM events
    UNION ALL SELECT 'hr_broken.json', 'json', 'heart_rate', 0, 1, 0, '', false, 'no record can be read'
    UNION ALL SELECT 'bed_broken.parquet', 'parquet', 'sleep', 0, 0, 0, '', false, 'no rows can be read'
    UNION ALL SELECT 'walk.xml', NULL, 'steps', 0, 0, 0, '', false, 'unsupported file format .xml'
"""


@query("s7_collection_status", FILES)
def _(t):
    return loaded(t).status.drop("source", "bytes").withColumn("metrics", F.array_join("metrics", ","))


RECORDS = f"""
    SELECT 'heart_rate' AS data_type, event_type AS person, 'heart_rate' AS metric, ts, {R('value')} AS value FROM events
    UNION ALL SELECT 'steps', event_type, 'step_count', ts, {R('floor(value * 40)')} FROM events WHERE event_type IN ('click', 'view')
    UNION ALL SELECT 'sleep', event_type, 'duration_minutes', ts, {R('value * 10')} FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'unknown', event_type, 'confidence', ts, CASE WHEN event_id % 10 > 0 THEN {R('value')} END FROM events WHERE event_type = 'error'
"""


@query("s7_collection_readings", f"SELECT data_type, person, metric, ts AS timestamp, value FROM ({RECORDS})")
def _(t):
    return plan.readings(loaded(t), KEYS).drop("source", "block", "line")


def aligned_sql(name: str, source: str, total: bool = False) -> str:
    """CTEs of the aligned series ``name`` of rows (person, ts, value)."""
    value = "coalesce(v, 0)" if total else (
        "CASE WHEN v IS NOT NULL THEN v ELSE pv + (nv - pv) * ((epoch_us(b) - epoch_us(pb))::double / (epoch_us(nb) - epoch_us(pb))) END"
    )
    return f"""
    {name}_s AS ({source}),
    {name}_k AS (SELECT person FROM {name}_s GROUP BY person
                 HAVING count(*) >= 2 AND (epoch_us(max(ts)) - epoch_us(min(ts))) / {MINUTES * 60_000_000}::double > count(*) * 5),
    {name}_a AS (SELECT person, time_bucket(INTERVAL {MINUTES} MINUTE, ts) AS b, {'sum' if total else 'avg'}(value) AS v FROM {name}_s GROUP BY ALL),
    {name}_g AS (SELECT person, unnest(generate_series(min(b), max(b), INTERVAL {MINUTES} MINUTE)) AS b FROM {name}_a GROUP BY person),
    {name}_w AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN v IS NOT NULL THEN b END IGNORE NULLS) OVER p AS pb,
                        first_value(v IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN v IS NOT NULL THEN b END IGNORE NULLS) OVER n AS nb
                 FROM {name}_g LEFT JOIN {name}_a USING (person, b)
                 WINDOW p AS (PARTITION BY person ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        n AS (PARTITION BY person ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    {name} AS (SELECT person, b AS ts, {value} AS value FROM {name}_w WHERE person NOT IN (SELECT person FROM {name}_k)
               UNION ALL SELECT person, ts, value FROM {name}_s WHERE person IN (SELECT person FROM {name}_k))
"""


CLIPPED = "CASE WHEN value < 30 THEN 30::double WHEN value > 220 THEN 220::double ELSE value END"
ALIGNED = ",".join(
    [
        aligned_sql("heart", f"SELECT event_type AS person, ts, {CLIPPED} AS value FROM events"),
        aligned_sql("steps", "SELECT event_type AS person, ts, floor(value * 40) AS value FROM events WHERE event_type IN ('click', 'view')", True),
        " sleep AS (SELECT event_type AS person, ts, least(value * 10, 1440::double) AS value FROM events WHERE event_type = 'signup')",
        aligned_sql(
            "notes",
            "SELECT person, ts, coalesce(v, median(v) OVER (PARTITION BY person)) AS value FROM"
            " (SELECT event_type AS person, ts, CASE WHEN event_id % 10 > 0 THEN value END AS v FROM events WHERE event_type = 'error')",
        ),
        """ aligned AS (SELECT 'heart_rate' AS data_type, 'heart_rate' AS metric, * FROM heart
                     UNION ALL SELECT 'steps', 'step_count', * FROM steps
                     UNION ALL SELECT 'sleep', 'duration_minutes', * FROM sleep
                     UNION ALL SELECT 'unknown', 'confidence', * FROM notes)""",
    ]
)


def preprocessed(t):
    return plan.preprocess(plan.readings(loaded(t), KEYS), KEYS, f"{MINUTES} min")


@query("l1_collection", f"WITH {ALIGNED} SELECT data_type, person, metric, ts AS timestamp, {R('value')} AS value FROM aligned")
def _(t):
    return preprocessed(t).data.drop("value_is_outlier")


@query(
    "l1_collection_validation",
    f"""
    WITH r AS ({RECORDS}),
    c AS (SELECT *, CASE WHEN metric = 'heart_rate' THEN {CLIPPED} WHEN metric = 'duration_minutes' THEN least(value, 1440::double) ELSE value END AS v FROM r),
    f AS (SELECT *, coalesce(v, median(v) OVER (PARTITION BY data_type, person)) AS w FROM c),
    q AS (SELECT data_type, person, quantile_cont(w, 0.25) AS q1, quantile_cont(w, 0.75) AS q3 FROM f GROUP BY ALL),
    o AS (SELECT data_type, person, metric, count(*) AS n, count(*) FILTER (value <> v) AS beyond, count(*) FILTER (value IS NULL) AS missing,
                 count(*) FILTER (w < q1 - 1.5::double * (q3 - q1) OR w > q3 + 1.5::double * (q3 - q1)) AS outs
          FROM f JOIN q USING (data_type, person) GROUP BY ALL)
    SELECT data_type, person, metric, n AS original_rows, 0::bigint AS invalid_timestamps, 0::bigint AS future_timestamps, 0::bigint AS old_timestamps,
           beyond AS out_of_range, (beyond > 0)::bigint AS issues, missing AS missing_before, 0::bigint AS missing_after, outs AS outliers, n AS final_rows,
           {R('''round_even((100::double * (0.4::double + greatest(0::double, 0.3::double - least((beyond > 0)::int * 0.05::double, 0.3::double))
              + (1 - outs::double / n) * 0.3::double))::decimal(28, 10), 2)''')} AS quality_score,
           0::bigint AS duplicates_removed, 0::bigint AS rows_removed
    FROM o
    """,
)
def _(t):
    return preprocessed(t).reports["validation"]


def analysed(t):
    return plan.analyse(loaded(t), KEYS, f"{MINUTES} min", forecaster="hour_profile")


MAIN = f"{ALIGNED}, main AS (SELECT data_type || ':' || person AS user_id, data_type, person, ts, value FROM aligned WHERE data_type <> 'unknown')"
MODEL = forecasts.MODEL.replace(forecasts.TRAIN, "SELECT user_id, ts, value AS y FROM main")
WINDOWS = """
    sized AS (SELECT data_type, person, count(*) AS n, CASE WHEN count(*) >= 60 THEN 60 WHEN count(*) >= 30 THEN 30 WHEN count(*) >= 15 THEN 15 ELSE 7 END AS size,
                     date_diff('day', min(ts)::date, max(ts)::date) + 1 AS days FROM main GROUP BY ALL),
    windows AS (SELECT data_type, person, n, CASE WHEN data_type = 'sleep' THEN (n >= 3 AND days >= 3)::bigint WHEN n < 10 THEN 0
                       ELSE (n - size) // (size // 2) + 1 END AS windows FROM sized)
"""
NOTES = "SELECT 'unknown', person, {} FROM notes GROUP BY person"


@query(
    "l2_collection_modeling",
    f"""
    WITH {MAIN}, {MODEL}
    SELECT data_type, person, 'hour_profile' AS model, count(*) AS training_rows, 100::bigint AS forecast_periods, {R('avg(abs(residual))')} AS mae,
           {R('sqrt(avg(residual * residual))')} AS rmse, {R('avg(abs(residual) / abs(y)) FILTER (y <> 0) * 100')} AS mape,
           count(*) FILTER (y = 0) AS mape_zero_rows, true AS success, NULL::varchar AS error
    FROM res JOIN (SELECT DISTINCT user_id, data_type, person FROM main) USING (user_id) GROUP BY ALL
    UNION ALL SELECT 'unknown', person, 'hour_profile', 0, 100, NULL, NULL, NULL, NULL, false, 'Unknown data type: unknown' FROM notes GROUP BY person
    """,
)
def _(t):
    return analysed(t).second.reports["modeling"]


@query(
    "l2_collection_extraction",
    f"""
    WITH {MAIN}, {WINDOWS}
    SELECT data_type, person, n AS original_rows, windows, windows > 0 AS success,
           CASE WHEN windows = 0 THEN 'No data available for feature extraction' END AS error FROM windows
    UNION ALL SELECT 'unknown', person, 0, 0, false, 'Unknown data type: unknown' FROM notes GROUP BY person
    """,
)
def _(t):
    return analysed(t).second.reports["extraction"]


def rule_sql(data_type: str, metric: str, low: int, high: int, lasting: int) -> str:
    texts = ("Low {} (<{})", "High {} (>{})", "Medium", "High") if lasting else ("Insufficient {}", "Excessive {}", "High", "Medium")
    window = f"(PARTITION BY person ORDER BY ts ROWS BETWEEN {max(lasting, 1) - 1} PRECEDING AND CURRENT ROW)"
    return f"""
    SELECT data_type, person, user_id, ts, value, value > {high} OR value < {low} AS threshold_violation, cold OR hot AS threshold_anomaly,
           CASE WHEN cold THEN '{texts[0].format(metric, low)}' WHEN hot THEN '{texts[1].format(metric, high)}' ELSE '' END AS anomaly_reason,
           CASE WHEN cold THEN '{texts[2]}' WHEN hot THEN '{texts[3]}' ELSE 'Normal' END AS severity
    FROM (SELECT *, count(*) FILTER (value < {low}) OVER w = {max(lasting, 1)} AS cold, count(*) FILTER (value > {high}) OVER w = {max(lasting, 1)} AS hot
          FROM main WHERE data_type = '{data_type}' WINDOW w AS {window})
    """


FLAGS = f"""
    flags AS ({rule_sql('heart_rate', 'heart_rate', 40, 120, 10)} UNION ALL {rule_sql('steps', 'step_count', 0, 1000, 5)}
              UNION ALL {rule_sql('sleep', 'duration_minutes', 180, 720, 0)}),
    near AS (SELECT f.*, yhat, value - yhat AS residual, yhat - 1.96::double * sigma AS lo, yhat + 1.96::double * sigma AS hi
             FROM flags f LEFT JOIN fc ON fc.user_id = f.user_id AND fc.ts = f.ts),
    far AS (SELECT user_id, stddev_samp(residual) AS std FROM near GROUP BY user_id),
    found AS (SELECT near.*, coalesce(abs(residual) > 3 * std, false) OR coalesce(value > hi OR value < lo, false) AS residual_anomaly
              FROM near JOIN far USING (user_id))
"""


@query(
    "l3_collection",
    f"""
    WITH {MAIN}, {MODEL}, {FLAGS}
    SELECT data_type, person, ts AS timestamp, {R('value')} AS value, threshold_violation, threshold_anomaly, anomaly_reason, severity,
           {R('yhat')} AS predicted, residual_anomaly FROM found
    UNION ALL SELECT 'unknown', person, ts, {R('value')}, NULL, NULL, NULL, NULL, NULL, false FROM notes
    """,
)
def _(t):
    columns = ["data_type", "person", "timestamp", "value", "threshold_violation", "threshold_anomaly", "anomaly_reason", "severity"]
    return analysed(t).third.data.select(*columns, "predicted", "residual_anomaly")


@query(
    "l3_collection_report",
    f"""
    WITH {MAIN}, {MODEL}, {FLAGS}, counts AS (
        SELECT data_type, person, 'Threshold-Based' AS method, count(*) AS total_records, count(*) FILTER (threshold_anomaly) AS anomalies_detected FROM found GROUP BY ALL
        UNION ALL SELECT data_type, person, 'Prophet Residual-Based', count(*), count(*) FILTER (residual_anomaly) FROM found GROUP BY ALL
        UNION ALL SELECT 'unknown', person, unnest(['Threshold-Based', 'Prophet Residual-Based']), count(*), 0 FROM notes GROUP BY person)
    SELECT *, {R('100::double * anomalies_detected / total_records')} AS anomaly_percentage FROM counts
    """,
)
def _(t):
    return analysed(t).third.reports["anomalies"]


@query(
    "l4_collection_status",
    f"""
    WITH {MAIN}, {WINDOWS}, r AS ({RECORDS}), files AS ({FILES}),
    rows AS (SELECT data_type, person, count(*) AS rows FROM r GROUP BY ALL),
    kept AS (SELECT data_type, person, count(*) AS aligned_rows FROM aligned GROUP BY ALL)
    SELECT file_name, data_type, person, rows.rows, aligned_rows, coalesce(windows, 0) AS windows, coalesce(windows, 0) > 0 AS success,
           CASE WHEN data_type = 'unknown' THEN 'Unknown data type: unknown' WHEN windows = 0 THEN 'No data available for feature extraction' END AS error
    FROM rows JOIN kept USING (data_type, person) LEFT JOIN windows USING (data_type, person) JOIN (SELECT file_name, data_type FROM files WHERE success) USING (data_type)
    UNION ALL SELECT file_name, data_type, NULL, 0, 0, 0, false, error FROM files WHERE NOT success
    """,
)
def _(t):
    status = analysed(t).status
    return status.withColumn("source", F.element_at(F.split("source", "/"), -1)).withColumnRenamed("source", "file_name")


@query(
    "l4_collection_clusters",
    f"""
    WITH {MAIN}, {WINDOWS}
    SELECT data_type, sum(windows)::bigint AS n_samples, (sum(windows) >= 2) AS success, CASE WHEN sum(windows) >= 2 THEN least(3, sum(windows))::bigint END AS clusters
    FROM windows GROUP BY data_type HAVING sum(windows) > 0
    """,
)
def _(t):
    models = analysed(t).second
    report = models.reports["clustering"].select("data_type", "n_samples", "success")
    found = models.clusters.groupBy("data_type").agg(F.count_distinct("cluster").alias("clusters"))
    return report.join(found, "data_type", "left").select(*report.columns, "clusters")
