"""Threshold, residual and cluster flags, and their summaries."""

from pyspark.sql import functions as F

from vitalgrid.operators import anomaly, forecast
from vitalgrid.queries import forecasts
from vitalgrid.queries.registry import R, query

ORDER = ["ts", "event_id"]
RULE = (5, 60, 3)

SUSTAINED = """
    SELECT *, CASE WHEN low THEN 'Low value (<5)' WHEN high THEN 'High value (>60)' ELSE '' END AS anomaly_reason,
           CASE WHEN low THEN 'Medium' WHEN high THEN 'High' ELSE 'Normal' END AS severity FROM (
        SELECT event_id, user_id, event_type, ts, value, value > 60 OR value < 5 AS violation,
               count(*) FILTER (value > 60) OVER w = 3 AS high, count(*) FILTER (value < 5) OVER w = 3 AS low
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
"""


def sustained(t):
    return anomaly.flag_thresholds(t.events, ["user_id"], "heart_rate", ORDER, "value", RULE)


@query("n1_threshold_violation", f"SELECT event_id, violation AS threshold_violation FROM ({SUSTAINED})")
def _(t):
    return sustained(t).select("event_id", "threshold_violation")


@query(
    "n2_sustained_threshold",
    f"SELECT event_id, high OR low AS threshold_anomaly, anomaly_reason, severity FROM ({SUSTAINED})",
)
def _(t):
    return sustained(t).select("event_id", "threshold_anomaly", "anomaly_reason", "severity")


INSTANT = """
    SELECT event_id, user_id, ts, duration_minutes, event_type,
           duration_minutes > 720 OR duration_minutes < 180 AS threshold_anomaly,
           CASE WHEN duration_minutes < 180 THEN 'Insufficient duration_minutes' WHEN duration_minutes > 720 THEN 'Excessive duration_minutes' ELSE '' END AS anomaly_reason,
           CASE WHEN duration_minutes < 180 THEN 'High' WHEN duration_minutes > 720 THEN 'Medium' ELSE 'Normal' END AS severity
    FROM (SELECT *, value * 6 AS duration_minutes FROM events)
"""


def instant(t):
    return anomaly.flag_thresholds(
        t.events.withColumn("duration_minutes", F.col("value") * 6), ["user_id"], "sleep", ORDER
    )


@query("n3_instant_threshold", f"SELECT event_id, threshold_anomaly, anomaly_reason, severity FROM ({INSTANT})")
def _(t):
    return instant(t).select("event_id", "threshold_anomaly", "anomaly_reason", "severity")


@query(
    "n4_threshold_report",
    f"""
    SELECT user_id, 'heart_rate' AS data_type, 'Threshold-Based' AS method, count(*) AS total_records,
           count(*) FILTER (high OR low) AS anomalies_detected,
           {R('100::double * count(*) FILTER (high OR low) / count(*)')} AS anomaly_percentage,
           5::bigint AS min_threshold, 60::bigint AS max_threshold, 3::bigint AS sustained_minutes
    FROM ({SUSTAINED}) GROUP BY user_id
    """,
)
def _(t):
    return anomaly.threshold_report(sustained(t), ["user_id"], "heart_rate", RULE)


RESIDUAL = f"""
    WITH {forecasts.MODEL},
    j AS (SELECT e.event_id, e.user_id, e.ts, e.value, fc.yhat AS predicted, e.value - fc.yhat AS residual,
                 fc.yhat - 1.96::double * fc.sigma AS lo, fc.yhat + 1.96::double * fc.sigma AS hi
          FROM events e LEFT JOIN fc ON fc.user_id = e.user_id AND fc.ts = e.ts),
    st AS (SELECT user_id, avg(residual) AS m, stddev_samp(residual) AS s FROM j GROUP BY user_id),
    rf AS (SELECT j.*, m, s, coalesce(abs(residual) > 2 * s, false) OR coalesce(value > hi OR value < lo, false) AS flag FROM j JOIN st USING (user_id))
"""


def residual(t):
    _train, predicted = forecasts.hourly_forecast(t)
    return anomaly.flag_residuals(t.events, predicted, ["user_id"], "ts", "value", 2.0)


@query(
    "n5_residual_anomaly",
    f"""
    {RESIDUAL}
    SELECT event_id, {R('predicted')} AS predicted, {R('residual')} AS residual, flag AS residual_anomaly,
           CASE WHEN flag THEN 'Deviates from predicted trend' ELSE '' END AS residual_anomaly_reason FROM rf
    """,
)
def _(t):
    return residual(t).select("event_id", "predicted", "residual", "residual_anomaly", "residual_anomaly_reason")


@query(
    "n5_residual_report",
    f"""
    {RESIDUAL}
    SELECT user_id, 'heart_rate' AS data_type, 'Prophet Residual-Based' AS method, count(*) AS total_records,
           count(*) FILTER (flag) AS anomalies_detected, {R('100::double * count(*) FILTER (flag) / count(*)')} AS anomaly_percentage,
           {R('avg(residual)')} AS residual_mean, {R('stddev_samp(residual)')} AS residual_std, {R('stddev_samp(residual) * 2')} AS residual_threshold
    FROM rf GROUP BY user_id
    """,
)
def _(t):
    return anomaly.residual_report(residual(t), ["user_id"], "heart_rate", 2.0)


LABELS = """
    SELECT o_orderkey, CASE WHEN o_totalprice > 490000 THEN 3 WHEN o_orderpriority = '5-LOW' THEN 2 WHEN o_orderstatus = 'P' THEN -1 ELSE 0 END::bigint AS cluster
    FROM orders
"""


def labelled(t):
    label = (
        F.when(F.col("o_totalprice") > 490000, 3)
        .when(F.col("o_orderpriority") == "5-LOW", 2)
        .when(F.col("o_orderstatus") == "P", -1)
        .otherwise(0)
    )
    return t.orders.select("o_orderkey", label.alias("cluster"))


CLUSTERED = f"""
    WITH c AS ({LABELS}), z AS (SELECT cluster, count(*) AS n, sum(count(*)) OVER () AS total FROM c GROUP BY cluster),
    f AS (SELECT o_orderkey, cluster, n, cluster = -1 OR n::double / total::double < 0.05::double AS cluster_anomaly,
                 CASE WHEN cluster = -1 THEN 'Noise point (DBSCAN)' WHEN n::double / total::double < 0.05::double THEN 'Belongs to small cluster #' || cluster ELSE '' END AS cluster_anomaly_reason
          FROM c JOIN z USING (cluster))
"""


@query("n6_cluster_anomaly", f"{CLUSTERED} SELECT o_orderkey, cluster, cluster_anomaly, cluster_anomaly_reason FROM f")
def _(t):
    return anomaly.flag_clusters(labelled(t))


@query(
    "n6_cluster_report",
    f"""
    {CLUSTERED}
    SELECT 'heart_rate' AS data_type, 'Cluster-Based' AS method, count(*) AS total_records, count(*) FILTER (cluster_anomaly) AS anomalies_detected,
           {R('100::double * count(*) FILTER (cluster_anomaly) / count(*)')} AS anomaly_percentage, count(DISTINCT cluster) AS total_clusters,
           list_aggregate(list_sort(list(DISTINCT cluster) FILTER (cluster_anomaly)), 'string_agg', ',') AS anomalous_clusters
    FROM f
    """,
)
def _(t):
    flagged = anomaly.flag_clusters(labelled(t))
    found = anomaly.cluster_distribution(flagged).filter("anomalous").agg(F.array_sort(F.collect_list("cluster")).alias("c"))
    texts = found.select(F.array_join(F.transform("c", lambda c: c.cast("string")), ",")).scalar()
    return anomaly.cluster_flag_report(flagged, [], "heart_rate").withColumn("anomalous_clusters", texts)


@query(
    "n6_cluster_distribution",
    f"""
    {CLUSTERED}
    SELECT cluster, count(*) AS records, bool_or(cluster_anomaly) AS anomalous, count(*) FILTER (cluster_anomaly) AS anomalies FROM f GROUP BY cluster
    """,
)
def _(t):
    return anomaly.cluster_distribution(anomaly.flag_clusters(labelled(t)))


@query(
    "n7_violation_log",
    f"""
    {RESIDUAL}
    SELECT user_id, ts, {R('value')} AS value, 'Threshold-Based' AS method FROM events WHERE value > 60 OR value < 5
    UNION ALL SELECT user_id, ts, {R('value')}, 'Prophet Residual-Based' FROM rf WHERE flag
    """,
)
def _(t):
    _train, predicted = forecasts.hourly_forecast(t)
    flagged = anomaly.flag_residuals(sustained(t), predicted, ["user_id"], "ts", "value", 2.0)
    return anomaly.violation_log(flagged, ["user_id"], "ts", "value")


def reports(t):
    first = anomaly.threshold_report(sustained(t), ["user_id"], "heart_rate", RULE)
    second = anomaly.threshold_report(instant(t), ["user_id"], "sleep")
    third = anomaly.residual_report(residual(t), ["user_id"], "heart_rate", 2.0)
    return first.unionByName(second).unionByName(third, allowMissingColumns=True)


COUNTS = f"""
    SELECT 'Heart Rate' AS data_type, 'Threshold-Based' AS method, count(*) FILTER (high OR low) AS anomalies, count(*) AS rows FROM ({SUSTAINED})
    UNION ALL SELECT 'Sleep', 'Threshold-Based', count(*) FILTER (threshold_anomaly), count(*) FROM ({INSTANT})
    UNION ALL SELECT 'Heart Rate', 'Prophet Residual-Based', count(*) FILTER (flag), count(*) FROM rf
"""


@query(
    "n8_breakdown",
    f"{RESIDUAL} SELECT data_type, method, anomalies, {R('round_even((100::double * anomalies / rows)::decimal(28, 10), 2)')} AS percentage FROM ({COUNTS})",
)
def _(t):
    return anomaly.breakdown(reports(t))


@query(
    "n8_breakdown_totals",
    f"""
    {RESIDUAL}
    SELECT sum(anomalies)::bigint AS total_anomalies, count(DISTINCT method) AS methods_used, count(DISTINCT data_type) AS types_analysed FROM ({COUNTS})
    """,
)
def _(t):
    return anomaly.breakdown_totals(reports(t))


def typed(t):
    return sustained(t).withColumn("data_type", F.col("event_type"))


@query(
    "n9_anomaly_totals",
    f"SELECT event_type AS data_type, count(*) FILTER (high OR low) AS anomalies FROM ({SUSTAINED}) GROUP BY event_type",
)
def _(t):
    return anomaly.anomaly_totals(typed(t))


@query(
    "n9_average_totals",
    f"""
    SELECT count(*) AS types_analysed, sum(anomalies)::bigint AS total_anomalies, {R('avg(anomalies)')} AS avg_per_type
    FROM (SELECT event_type, count(*) FILTER (high OR low) AS anomalies FROM ({SUSTAINED}) GROUP BY event_type)
    """,
)
def _(t):
    return anomaly.average_totals(anomaly.anomaly_totals(typed(t)))


@query("n10_timeline", f"SELECT event_type AS data_type, ts FROM ({SUSTAINED}) WHERE high OR low")
def _(t):
    return anomaly.timeline(typed(t), "ts")


@query(
    "n11_severity_counts",
    f"""
    SELECT 'High' AS severity, count(*) FILTER (severity = 'High') AS records FROM ({SUSTAINED})
    UNION ALL SELECT 'Medium', count(*) FILTER (severity = 'Medium') FROM ({SUSTAINED})
    UNION ALL SELECT 'Low', count(*) FILTER (severity = 'Low') FROM ({SUSTAINED})
    """,
)
def _(t):
    return anomaly.severity_counts(sustained(t))
