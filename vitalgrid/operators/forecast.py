"""Per-series forecasts: two trend models, prediction, residuals, accuracy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import TOO_FEW_READINGS
from vitalgrid.functions.expressions import from_micros, micros, nan_is_missing, share
from vitalgrid.plans.series import Series, attach, has_large_series, max_series_rows, spread

INTERVAL = 1.96
DAY_US = 86_400_000_000
REFERENCE_US = 1_577_836_800_000_000  # 2020-01-01, keeps the day numbers small


@nan_is_missing
def training_frame(
    df: DataFrame, keys: list[str], ts: str, value: str, sliced: bool | None = None
) -> DataFrame:
    """(keys, ts, y) without nulls, for series with at least two rows."""
    known = df.select(*keys, F.col(ts).alias("ts"), F.col(value).cast("double").alias("y")).dropna(subset=["ts", "y"])
    return Series.of(known, keys, ["ts"], sliced).size("_n").filter(F.col("_n") >= 2).drop("_n").done()


def future_grid(train: DataFrame, keys: list[str], periods: int = 100, step_seconds: int = 60) -> DataFrame:
    """Every moment of the history once, and ``periods`` steps after the last one."""
    kind = train.schema["ts"].dataType
    history = train.select(*keys, "ts").distinct().withColumn("is_future", F.lit(False))
    last = train.groupBy(*keys).agg(F.max(micros("ts")).alias("_last"))
    step = F.lit(step_seconds * 1_000_000)
    ahead = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(periods).cast("long")))
    future = last.withColumn("_i", ahead)
    future = future.select(*keys, from_micros(F.col("_last") + F.col("_i") * step, kind).alias("ts"), F.lit(True).alias("is_future"))
    return history.unionByName(future)


# hour profile: a straight line plus the mean deviation of each hour of the day -------------------


def _days(us: Column) -> Column:
    return us / F.lit(float(DAY_US))


def fit_hour_profile(train: DataFrame, keys: list[str], sliced: bool | None = None) -> DataFrame:
    """One row per series: start, intercept there, slope per day, deviation per hour, residual size."""
    day = _days(micros("ts") - F.lit(REFERENCE_US))
    series = Series.of(train, keys, ["ts"], sliced).stats(
        {
            "start_us": F.min(micros("ts")),
            "last_us": F.max(micros("ts")),
            "_my": F.avg("y"),
            "_mt": F.avg(day),
            "_cov": F.covar_pop("y", day),
            "_var": F.var_pop(day),
        }
    )
    slope = F.coalesce(F.try_divide(F.col("_cov"), F.col("_var")), F.lit(0.0))
    at_start = _days(F.col("start_us") - F.lit(REFERENCE_US))
    series = series.with_columns({"slope": slope})
    series = series.with_columns({"intercept": F.col("_my") + F.col("slope") * (at_start - F.col("_mt"))})
    rows = series.done().withColumn("_d", F.col("y") - _line())
    line = ["start_us", "last_us", "slope", "intercept"]
    hours = rows.groupBy(*keys, F.hour("ts").alias("_h")).agg(
        F.avg("_d").alias("_m"),
        F.var_pop("_d").alias("_v"),
        F.count("*").alias("_c"),
        *[F.any_value(c).alias(c) for c in line],
    )
    return hours.groupBy(*keys).agg(
        *[F.any_value(c).alias(c) for c in line],
        F.map_from_entries(F.collect_list(F.struct("_h", "_m"))).alias("profile"),
        F.sqrt(F.sum(F.col("_v") * F.col("_c")) / F.sum("_c")).alias("sigma"),
        F.sum("_c").alias("training_rows"),
    )


def _line() -> Column:
    return F.col("intercept") + F.col("slope") * _days(micros("ts") - F.col("start_us"))


def predict_hour_profile(model: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    rows = attach(grid, model, keys)
    hour = F.coalesce(F.try_element_at(F.col("profile"), F.hour("ts")), F.lit(0.0))
    yhat = _line() + hour
    return _with_interval(rows, grid, yhat)


def _with_interval(rows: DataFrame, grid: DataFrame, yhat: Column) -> DataFrame:
    reach = INTERVAL * F.col("sigma")
    return rows.withColumn("yhat", yhat).withColumns(
        {"yhat_lower": F.col("yhat") - reach, "yhat_upper": F.col("yhat") + reach}
    ).select(*grid.columns, "yhat", "yhat_lower", "yhat_upper")


# trend with changepoints and daily seasonality: ridge regression ------------------------------------


@dataclass(frozen=True)
class Shape:
    """Changes of the trend and harmonics of the day. Changes lie evenly in the first ``KNOTS_UPTO`` of a series."""

    changepoints: int = 25
    harmonics: int = 10

    @property
    def terms(self) -> int:
        return 2 + self.changepoints + 2 * self.harmonics

    @property
    def step(self) -> float:
        return KNOTS_UPTO / (self.changepoints + 1)

    @property
    def ridge(self) -> np.ndarray:
        return np.array([0.0, 0.0] + [1.0] * (self.terms - 2))

    def design(self, t: np.ndarray, day: np.ndarray) -> np.ndarray:
        """Intercept, slope, hinges, sines, cosines."""
        hinges = np.maximum(0.0, t[:, None] - self.step * np.arange(1, self.changepoints + 1)[None, :])
        angle = 2 * np.pi * day[:, None] * np.arange(1, self.harmonics + 1)[None, :]
        return np.hstack([np.ones((len(t), 1)), t[:, None], hinges, np.sin(angle), np.cos(angle)])


KNOTS_UPTO = 0.8
SHAPE = Shape()


def _sums(table: pa.Table, shape: Shape) -> np.ndarray:
    """X'X, X'y, y'y and n as one vector; rows carry how many readings share their moment."""
    total = np.zeros(shape.terms * shape.terms + shape.terms + 2)
    t, day, w, sy, syy = (table[c].to_numpy() for c in ("_t", "_day", "_w", "_sy", "_syy"))
    for begin in range(0, len(t), 50_000):
        part = slice(begin, begin + 50_000)
        x = shape.design(t[part], day[part])
        gram = (x * w[part, None]).T @ x
        total += np.concatenate([gram.ravel(), x.T @ sy[part], [syy[part].sum(), w[part].sum()]])
    return total


def _solve(sums: np.ndarray, shape: Shape) -> tuple[np.ndarray, float]:
    n_terms = shape.terms
    gram = sums[: n_terms * n_terms].reshape(n_terms, n_terms)
    moment, yy, n = sums[n_terms * n_terms : -2], sums[-2], sums[-1]
    ridged = gram + np.diag(shape.ridge)
    try:
        beta = np.linalg.solve(ridged, moment)
    except np.linalg.LinAlgError:  # all readings at one moment
        beta = np.linalg.lstsq(ridged, moment, rcond=None)[0]
    sse = yy - 2 * beta @ moment + beta @ gram @ beta
    return beta, float(np.sqrt(max(sse, 0.0) / n))


def fit_seasonal_trend(train: DataFrame, keys: list[str], sliced: bool | None = None, shape: Shape = SHAPE) -> DataFrame:
    """One row per series: start, length, mean and a coefficient for each term of ``shape``.

    Readings of one moment are merged before anything is shuffled. A series that fits one task is
    solved there. A longer one is spread over parts by a hash of the moment; each part adds up its
    normal equations and only those sums (a fixed size) meet in one task.
    """
    facts = train.groupBy(*keys).agg(
        F.min(micros("ts")).alias("start_us"),
        F.greatest(F.max(micros("ts")) - F.min(micros("ts")), F.lit(1)).alias("length_us"),
        F.avg("y").alias("level"),
        F.count("*").alias("training_rows"),
    )
    limit = max_series_rows(train.sparkSession)
    if sliced is None:
        sliced = has_large_series(train, keys)
    key_fields = [train.schema[k] for k in keys]
    solved = T.StructType(
        [*key_fields, T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType())]
    )
    summed = T.StructType([*key_fields, T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def answer(table: pa.Table, sums: np.ndarray) -> pa.Table:
        beta, sigma = _solve(sums, shape)
        first = table.select(keys).slice(0, 1)
        first = first.append_column("beta", pa.array([beta], pa.list_(pa.float64())))
        return first.append_column("sigma", pa.array([sigma], pa.float64()))

    def solve_series(table: pa.Table) -> pa.Table:
        return answer(table, _sums(table, shape))

    def sum_part(table: pa.Table) -> pa.Table:
        sums = pa.array([_sums(table, shape)], pa.list_(pa.float64()))
        return table.select(keys).slice(0, 1).append_column("sums", sums)

    def solve_sums(table: pa.Table) -> pa.Table:
        return answer(table, np.array(table["sums"][0].as_py()))

    if keys and not sliced:
        train = spread(train, keys)
    rows = _moments(train, facts, keys)
    if not sliced:
        return attach(facts, rows.groupBy(*keys).applyInArrow(solve_series, solved), keys)
    part = F.pmod(F.xxhash64("_t"), F.ceil(F.col("training_rows") / F.lit(limit)))
    parts = rows.withColumn("_part", part).groupBy(*keys, "_part").applyInArrow(sum_part, summed)
    # the parts add up index by index, pre-aggregated; one row a series is left to solve
    cells = parts.select(*keys, F.posexplode("sums").alias("_i", "_x")).groupBy(*keys, "_i").agg(F.sum("_x").alias("_x"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda c: c["_x"])
    whole = cells.groupBy(*keys).agg(in_order.alias("sums"))
    return attach(facts, whole.groupBy(*keys).applyInArrow(solve_sums, solved), keys)


def _moments(train: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Readings of one moment merged: place in the series (0..1), time of day, weight and sums of
    the centred values."""
    rows = attach(train, facts, keys)
    us, y = micros("ts"), F.col("y") - F.col("level")
    place = ((us - F.col("start_us")) / F.col("length_us")).alias("_t")
    day = (F.pmod(us, F.lit(DAY_US)) / F.lit(float(DAY_US))).alias("_day")
    rows = rows.select(*keys, "training_rows", place, day, y.alias("_y"))
    return rows.groupBy(*keys, "training_rows", "_t", "_day").agg(
        F.count("*").cast("double").alias("_w"), F.sum("_y").alias("_sy"), F.sum(F.col("_y") * F.col("_y")).alias("_syy")
    )


def _trend(model: DataFrame, shape: Shape) -> DataFrame:
    """Per series, level and slope of the trend between any two changes (``_base`` and ``_slope``, by the number
    of changes passed)."""
    passed = f"sequence(0, {shape.changepoints})"
    slope = f"transform({passed}, m -> aggregate(slice(beta, 2, m + 1), 0D, (a, x) -> a + x))"
    weighted = f"transform(slice(beta, 3, {shape.changepoints}), (b, i) -> b * (i + 1) * {shape.step!r}D)"
    base = f"transform({passed}, m -> beta[0] - aggregate(slice({weighted}, 1, m), 0D, (a, x) -> a + x))"
    return model.withColumns({"_slope": F.expr(slope), "_base": F.expr(base)})


def predict_seasonal_trend(model: DataFrame, grid: DataFrame, keys: list[str], shape: Shape = SHAPE) -> DataFrame:
    """The trend is a look-up of the piece that a moment lies in. The waves are summed by Clenshaw's
    recurrence y[k] = b[k] + 2 cos(a) y[k + 1] - y[k + 2], which needs one sine and one cosine; every step is a
    projection of its own, so no generated method grows too long to be compiled."""
    rows = attach(grid, _trend(model.filter(F.col("beta").isNotNull()), shape), keys)
    t = F.coalesce((micros("ts") - F.col("start_us")) / F.col("length_us"), F.lit(0.0))
    day = F.pmod(micros("ts"), F.lit(DAY_US)) / F.lit(float(DAY_US))
    piece = F.least(F.greatest(F.floor(t / F.lit(shape.step)), F.lit(0)), F.lit(shape.changepoints)).cast("int")
    angle = F.lit(2 * np.pi) * day
    rows = rows.withColumns({"_t": t, "_piece": piece, "_cos": F.cos(angle), "_sin": F.sin(angle)})
    zero = F.lit(0.0)
    ahead = {n: (zero, zero) for n in "sc"}  # y[k + 1] and y[k + 2]
    first = {"s": 1 + shape.changepoints, "c": 1 + shape.changepoints + shape.harmonics}
    for k in range(shape.harmonics, 0, -1):
        now = {f"_{n}{k}": F.get("beta", F.lit(first[n] + k)) + 2 * F.col("_cos") * ahead[n][0] - ahead[n][1] for n in "sc"}
        rows = rows.withColumns(now)
        ahead = {n: (F.col(f"_{n}{k}"), ahead[n][0]) for n in "sc"}
    waves = ahead["s"][0] * F.col("_sin") + ahead["c"][0] * F.col("_cos") - ahead["c"][1]
    trend = F.get("_base", F.col("_piece")) + F.get("_slope", F.col("_piece")) * F.col("_t")
    return _with_interval(rows, grid, F.col("level") + (trend + waves))


MODELS = {
    "hour_profile": (fit_hour_profile, predict_hour_profile),
    "seasonal_trend": (fit_seasonal_trend, predict_seasonal_trend),
}


# residuals -------------------------------------------------------------------------------------


def residual_frame(train: DataFrame, forecast: DataFrame, keys: list[str]) -> DataFrame:
    """Readings next to a forecast by series and time; times without a forecast stay, with nulls."""
    return with_residuals(attach(train, forecast.select(*keys, "ts", "yhat", "yhat_lower", "yhat_upper"), [*keys, "ts"]))


def with_residuals(rows: DataFrame) -> DataFrame:
    return rows.withColumn("residual", F.col("y") - F.col("yhat")).withColumn("residual_abs", F.abs("residual"))


def accuracy(residuals: DataFrame, keys: list[str]) -> DataFrame:
    """Mean absolute, root mean square and mean absolute percentage error. Rows with a value of 0
    have no percentage error and are counted instead."""
    r, y = F.col("residual"), F.col("y")
    return residuals.groupBy(*keys).agg(
        F.count("*").alias("training_rows"),
        F.avg(F.abs(r)).alias("mae"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        (F.avg(F.when(y != 0, F.try_divide(F.abs(r), F.abs(y)))) * 100).alias("mape"),
        F.count_if(y == 0).alias("mape_zero_rows"),
    )


def residual_outliers(residuals: DataFrame, keys: list[str], threshold_std: float = 3.0) -> DataFrame:
    """Rows whose residual is beyond mean ± threshold · sample deviation, with a score."""
    stats = residuals.groupBy(*keys).agg(F.avg("residual").alias("_mean"), F.stddev_samp("residual").alias("_std"))
    away = F.abs(F.col("residual") - F.col("_mean"))
    rows = attach(residuals, stats, keys).filter(away > threshold_std * F.col("_std"))
    return rows.withColumn("anomaly_score", F.try_divide(away, F.col("_std"))).drop("_mean", "_std")


def fit_and_predict(
    df: DataFrame,
    keys: list[str],
    data_type: str,
    ts: str,
    value: str,
    periods: int = 100,
    model: str = "seasonal_trend",
    step_seconds: int = 60,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns the forecast (history and future), the residuals and a report per series."""
    fit, predict = MODELS[model]
    sliced = has_large_series(df, keys)
    train = training_frame(df, keys, ts, value, sliced)
    fitted = fit(train, keys, sliced)
    forecast = predict(fitted, future_grid(train, keys, periods, step_seconds), keys)
    # the forecast at a training row depends on its time alone: no join on the time is needed
    residuals = with_residuals(predict(fitted, train, keys))
    everyone = df.groupBy(*keys).agg(F.count(value).alias("_known"))
    report = attach(everyone, accuracy(residuals, keys), keys).select(
        *keys,
        F.lit(data_type).alias("data_type"),
        F.lit(model).alias("model"),
        F.coalesce("training_rows", "_known").alias("training_rows"),
        F.lit(periods).alias("forecast_periods"),
        "mae",
        "rmse",
        "mape",
        "mape_zero_rows",
        F.col("mae").isNotNull().alias("success"),
        F.when(F.col("mae").isNull(), F.lit(TOO_FEW_READINGS)).alias("error"),
    )
    return forecast, residuals, report
