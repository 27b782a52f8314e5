"""Forecasts, residuals, accuracy."""

from pyspark.sql import functions as F

from vitalgrid.operators import forecast
from vitalgrid.queries.registry import R, query

TRAIN = """
    SELECT user_id, ts, y FROM (SELECT user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS y FROM events)
    WHERE y IS NOT NULL
"""

MODEL = f"""
    train AS ({TRAIN}),
    start AS (SELECT user_id, min(ts) AS first, max(ts) AS last FROM train GROUP BY user_id),
    timed AS (SELECT user_id, ts, y, (epoch_us(ts) - epoch_us(first)) / 86400000000::double AS t FROM train JOIN start USING (user_id)),
    line AS (SELECT user_id, coalesce(regr_slope(y, t), 0) AS slope, avg(y) - coalesce(regr_slope(y, t), 0) * avg(t) AS intercept FROM timed GROUP BY user_id),
    resid AS (SELECT user_id, hour(ts) AS h, y - intercept - slope * t AS d FROM timed JOIN line USING (user_id)),
    profile AS (SELECT user_id, h, avg(d) AS m FROM resid GROUP BY user_id, h),
    noise AS (SELECT user_id, sqrt(avg((d - m) * (d - m))) AS sigma, count(*) AS n FROM resid JOIN profile USING (user_id, h) GROUP BY user_id),
    grid AS (SELECT DISTINCT user_id, ts, false AS is_future FROM train
             UNION ALL SELECT user_id, last + to_minutes(i), true FROM start, (SELECT unnest(range(1, 101)) AS i)),
    fc AS (SELECT g.user_id, g.ts, is_future, intercept + slope * ((epoch_us(g.ts) - epoch_us(first)) / 86400000000::double) + coalesce(m, 0) AS yhat, sigma
           FROM grid g JOIN line USING (user_id) JOIN start USING (user_id) JOIN noise USING (user_id)
           LEFT JOIN profile p ON p.user_id = g.user_id AND p.h = hour(g.ts)),
    res AS (SELECT train.user_id, train.ts, y, yhat, sigma, y - yhat AS residual FROM train JOIN fc USING (user_id, ts))
"""

FITS = ["user_id"]


def gappy(t):
    return t.events.select("user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))


def train(t):
    return forecast.training_frame(gappy(t), FITS, "ts", "value")


def hourly_forecast(t):
    rows = train(t)
    model = forecast.fit_hour_profile(rows, FITS)
    return rows, forecast.predict_hour_profile(model, forecast.future_grid(rows, FITS), FITS)


def residuals(t):
    return forecast.residual_frame(*hourly_forecast(t), FITS)


@query("r1_training_frame", f"SELECT user_id, ts, {R('y')} AS y FROM ({TRAIN})")
def _(t):
    return train(t)


@query("r2_future_grid", f"WITH {MODEL} SELECT user_id, ts, is_future FROM grid")
def _(t):
    return forecast.future_grid(train(t), FITS)


@query(
    "r3_fit_hour_profile",
    f"""
    WITH {MODEL}
    SELECT user_id, {R('slope')} AS slope, {R('intercept')} AS intercept, {R('sigma')} AS sigma, n AS training_rows
    FROM line JOIN noise USING (user_id)
    """,
)
def _(t):
    return forecast.fit_hour_profile(train(t), FITS).select("user_id", "slope", "intercept", "sigma", "training_rows")


@query("r3_fit_seasonal_trend")
def _(t):
    model = forecast.fit_seasonal_trend(train(t), FITS)
    return model.select("user_id", "training_rows", "level", "sigma", F.size("beta").alias("terms"))


@query(
    "r4_predict",
    f"""
    WITH {MODEL}
    SELECT user_id, ts, is_future, {R('yhat')} AS yhat, {R('yhat - 1.96::double * sigma')} AS yhat_lower,
           {R('yhat + 1.96::double * sigma')} AS yhat_upper FROM fc
    """,
)
def _(t):
    return hourly_forecast(t)[1]


@query("r4_predict_seasonal_trend")
def _(t):
    rows = train(t)
    return forecast.predict_seasonal_trend(forecast.fit_seasonal_trend(rows, FITS), forecast.future_grid(rows, FITS), FITS)


# a line and one wave a day: the same model with four terms, small enough to be solved in SQL
FOUR = forecast.Shape(changepoints=0, harmonics=1)


def solved(n: int) -> str:
    """CTEs that solve the system of n equations in ``system`` (m00 … and right sides m0n …) by elimination."""
    steps, before = [], "system"
    for k in range(n):
        cells = [
            f"{f'm{k}{j} / m{k}{k}' if i == k else f'm{i}{j} - m{i}{k} * m{k}{j} / m{k}{k}'} AS m{i}{j}"
            for i in range(n)
            for j in range(n + 1)
        ]
        steps.append(f"e{k} AS (SELECT user_id, {', '.join(cells)} FROM {before})")
        before = f"e{k}"
    return ",\n    ".join(steps)


TERMS = ["1::double", "t", "sin(2 * pi() * d)", "cos(2 * pi() * d)"]
DAY = "((epoch_us({}) % 86400000000) / 86400000000::double)"
CELLS = [f"sum(x{i} * x{j}){' + 1' if i == j > 1 else ''} AS m{i}{j}" for i in range(4) for j in range(4)] + [f"sum(x{i} * z) AS m{i}4" for i in range(4)]
FOUR_SQL = f"""
    train AS ({TRAIN}),
    facts AS (SELECT user_id, min(ts) AS first, max(ts) AS last, greatest(epoch_us(max(ts)) - epoch_us(min(ts)), 1) AS length, avg(y) AS level, count(*) AS n
              FROM train GROUP BY user_id),
    placed AS (SELECT user_id, y - level AS z, (epoch_us(ts) - epoch_us(first)) / length::double AS t, {DAY.format('ts')} AS d FROM train JOIN facts USING (user_id)),
    x AS (SELECT user_id, z, {', '.join(f'{c} AS x{i}' for i, c in enumerate(TERMS))} FROM placed),
    system AS (SELECT user_id, {', '.join(CELLS)} FROM x GROUP BY user_id),
    {solved(4)},
    beta AS (SELECT user_id, m04 AS b0, m14 AS b1, m24 AS b2, m34 AS b3 FROM e3),
    noise AS (SELECT user_id, sqrt(avg((z - b0 - b1 * x1 - b2 * x2 - b3 * x3) ** 2)) AS sigma FROM x JOIN beta USING (user_id) GROUP BY user_id),
    grid AS (SELECT DISTINCT user_id, ts, false AS is_future FROM train
             UNION ALL SELECT user_id, last + to_minutes(i), true FROM facts, (SELECT unnest(range(1, 101)) AS i)),
    places AS (SELECT g.*, level, sigma, b0, b1, b2, b3, (epoch_us(ts) - epoch_us(first)) / length::double AS t, {DAY.format('ts')} AS d
           FROM grid g JOIN facts USING (user_id) JOIN beta USING (user_id) JOIN noise USING (user_id)),
    fc AS (SELECT *, level + b0 + b1 * t + b2 * sin(2 * pi() * d) + b3 * cos(2 * pi() * d) AS yhat FROM places)
"""


def four_terms(t):
    rows = train(t)
    return rows, forecast.fit_seasonal_trend(rows, FITS, shape=FOUR)


@query(
    "r3_fit_four_terms",
    f"""
    WITH {FOUR_SQL}
    SELECT user_id, n AS training_rows, {R('level')} AS level, {R('sigma')} AS sigma, {R('b0')} AS b0, {R('b1')} AS b1, {R('b2')} AS b2, {R('b3')} AS b3
    FROM facts JOIN beta USING (user_id) JOIN noise USING (user_id)
    """,
)
def _(t):
    _rows, model = four_terms(t)
    return model.select("user_id", "training_rows", "level", "sigma", *[F.col("beta")[i].alias(f"b{i}") for i in range(4)])


@query(
    "r4_predict_four_terms",
    f"""
    WITH {FOUR_SQL}
    SELECT user_id, ts, is_future, {R('yhat')} AS yhat, {R('yhat - 1.96::double * sigma')} AS yhat_lower, {R('yhat + 1.96::double * sigma')} AS yhat_upper FROM fc
    """,
)
def _(t):
    rows, model = four_terms(t)
    return forecast.predict_seasonal_trend(model, forecast.future_grid(rows, FITS), FITS, FOUR)


@query(
    "r5_residuals",
    f"WITH {MODEL} SELECT user_id, ts, {R('y')} AS y, {R('yhat')} AS yhat, {R('residual')} AS residual, {R('abs(residual)')} AS residual_abs FROM res",
)
def _(t):
    return residuals(t).drop("yhat_lower", "yhat_upper")


@query(
    "r6_accuracy",
    f"""
    WITH {MODEL}
    SELECT user_id, count(*) AS training_rows, {R('avg(abs(residual))')} AS mae, {R('sqrt(avg(residual * residual))')} AS rmse,
           {R('avg(abs(residual) / abs(y)) FILTER (y <> 0) * 100')} AS mape, count(*) FILTER (y = 0) AS mape_zero_rows
    FROM res GROUP BY user_id
    """,
)
def _(t):
    return forecast.accuracy(residuals(t), FITS)


@query(
    "r7_residual_outliers",
    f"""
    WITH {MODEL}, st AS (SELECT user_id, avg(residual) AS m, stddev_samp(residual) AS s FROM res GROUP BY user_id)
    SELECT user_id, ts, {R('residual')} AS residual, {R('abs(residual - m) / s')} AS anomaly_score
    FROM res JOIN st USING (user_id) WHERE abs(residual - m) > 3 * s
    """,
)
def _(t):
    return forecast.residual_outliers(residuals(t), FITS).select("user_id", "ts", "residual", "anomaly_score")
