"""The three stages and the whole run."""

from pyspark.sql import functions as F

from vitalgrid.plans import stages
from vitalgrid.queries import anomalies, forecasts, times
from vitalgrid.queries.registry import R, query


def heart(t):
    return t.events.select("event_type", "event_id", "ts", F.col("value").alias("heart_rate"))


CLIPPED = "SELECT event_type, event_id, ts, CASE WHEN value < 30 THEN 30::double WHEN value > 220 THEN 220::double ELSE value END AS value FROM events"


@query("l1_preprocess", times.ALIGNED.replace("FROM events", f"FROM ({CLIPPED})"))
def _(t):
    stage = stages.preprocess(heart(t), ["event_type"], "heart_rate", "ts", "15 min", "interpolate", ["ts", "event_id"])
    return stage.data.select("event_type", "ts", "heart_rate")


@query(
    "l1_preprocess_summary",
    f"""
    WITH c AS ({CLIPPED}),
    q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM c GROUP BY event_type),
    o AS (SELECT event_type, count(*) AS n, count(*) FILTER (value < q1 - 1.5::double * (q3 - q1) OR value > q3 + 1.5::double * (q3 - q1)) AS outs
          FROM c JOIN q USING (event_type) GROUP BY event_type),
    i AS (SELECT event_type, (count(*) FILTER (value < 30 OR value > 220) > 0)::int AS issues,
                 time_bucket(INTERVAL 1 HOUR, min(ts)) AS b0, time_bucket(INTERVAL 1 HOUR, max(ts)) AS b1 FROM events GROUP BY event_type)
    SELECT event_type, 'heart_rate' AS data_type, ((epoch_us(b1) - epoch_us(b0)) // 3600000000 + 1)::bigint AS records, 3::bigint AS columns,
           {R("round_even((100::double * (0.4::double + greatest(0::double, 0.3::double - least(issues * 0.05::double, 0.3::double)) + (1 - outs::double / n) * 0.3::double))::decimal(28, 10), 2)")} AS quality_score,
           {R("(epoch_us(b1) - epoch_us(b0)) / 3600000000::double")} AS span_hours
    FROM o JOIN i USING (event_type)
    """,
)
def _(t):
    stage = stages.preprocess(heart(t), ["event_type"], "heart_rate", "ts", "1 hour", "interpolate", ["ts", "event_id"])
    return stage.reports["summary"]


@query("l2_model")
def _(t):
    result = stages.model(t.events, ["user_id"], "heart_rate", "ts", "value", forecaster="hour_profile")
    return result.clusters.select("user_id", "window_id", "cluster", "pc1", "pc2")


@query(
    "l3_detect",
    f"""
    {anomalies.RESIDUAL}
    SELECT event_id, s.violation AS threshold_violation, s.high OR s.low AS threshold_anomaly, s.severity, rf.flag AS residual_anomaly
    FROM ({anomalies.SUSTAINED}) s JOIN rf USING (event_id)
    """,
)
def _(t):
    _train, predicted = forecasts.hourly_forecast(t)
    stage = stages.detect(
        t.events, ["user_id"], "heart_rate", "ts", "value", ["ts", "event_id"], predicted, rule=anomalies.RULE, threshold_std=2.0
    )
    return stage.data.select("event_id", "threshold_violation", "threshold_anomaly", "severity", "residual_anomaly")


@query("l4_analyse")
def _(t):
    df = heart(t)
    _first, _second, third = stages.analyse(
        df, ["event_type"], "heart_rate", "ts", target="1 hour", order=["ts", "event_id"], forecaster="hour_profile"
    )
    return third.data.select(
        "event_type", "ts", "heart_rate", "threshold_anomaly", "severity", "predicted", "residual_anomaly"
    )
