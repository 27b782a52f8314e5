"""Overlapping row windows and the features computed on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.catalog import NO_WINDOWS
from vitalgrid.functions.expressions import nan_is_missing
from vitalgrid.functions.stats import approximate_entropy_of
from vitalgrid.operators.align import DAY, resample
from vitalgrid.plans.series import Series, attach, has_large_series
from vitalgrid.plans.summaries import quantiles
from vitalgrid.session import stored

MIN_ROWS = 10
MIN_DAYS = 3
PREFIX = "value__"


def window_size(rows: Column, requested: int = 60) -> Column:
    """The requested size, halved while the series is shorter and the size is above ten; null for
    a series of fewer than ten rows."""
    sizes = [requested]
    while sizes[-1] > MIN_ROWS:
        sizes.append(sizes[-1] // 2)
    chosen = F.lit(sizes[-1])
    for s in reversed(sizes[:-1]):
        chosen = F.when(rows >= s, F.lit(s)).otherwise(chosen)
    return F.when(rows >= MIN_ROWS, chosen)


@nan_is_missing
def window_sizes(df: DataFrame, keys: list[str], value: str, requested: int = 60) -> DataFrame:
    sized = df.groupBy(*keys).agg(F.count(value).alias("rows"))
    return sized.withColumns(
        {"requested_size": F.lit(requested), "window_size": window_size(F.col("rows"), requested)}
    )


@nan_is_missing
def to_windows(
    df: DataFrame, keys: list[str], value: str, order: list[str], requested: int = 60, sliced: bool | None = None
) -> DataFrame:
    """Rows repeated into every full window they belong to: (keys, window_id, pos, ts…, value).
    Windows advance by half their size; a row's windows follow from its position alone."""
    known = df.filter(F.col(value).isNotNull()).select(*dict.fromkeys([*keys, *order, value]))
    series = Series.of(known, keys, order, sliced).position("_row").size("_rows")
    rows = series.done().withColumn("_size", window_size(F.col("_rows"), requested)).filter(F.col("_size").isNotNull())
    step = F.greatest(F.lit(1), F.floor(F.col("_size") / 2))
    rows = rows.withColumn("_step", step)
    first = F.greatest(F.lit(0), F.ceil((F.col("_row") - F.col("_size") + 1) / F.col("_step")))
    last = F.least(F.floor(F.col("_row") / F.col("_step")), F.floor((F.col("_rows") - F.col("_size")) / F.col("_step")))
    rows = rows.withColumns({"_first": first.cast("long"), "_last": last.cast("long")}).filter("_first <= _last")
    rows = rows.withColumn("window_id", F.explode(F.sequence("_first", "_last")))
    pos = F.col("_row") - F.col("window_id") * F.col("_step")
    return rows.select(
        *keys, "window_id", pos.cast("long").alias("pos"), *[c for c in order if c not in keys], F.col(value).cast("double").alias("value")
    )


def sleep_windows(df: DataFrame, keys: list[str], ts: str, value: str, sliced=None) -> DataFrame:
    """Daily sums, the whole series as window 0; needs three rows and three days."""
    enough = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= MIN_DAYS)
    daily = resample(df, keys, ts, DAY, {value: "sum"}, [ts], True, sliced)
    series = Series.of(daily, keys, [ts], sliced).position("pos").size("_days")
    days = attach(series.done(), enough, keys).filter((F.col("_days") >= MIN_DAYS) & F.col("_n").isNotNull())
    return days.select(
        *keys, F.lit(0).cast("long").alias("window_id"), "pos", ts, F.col(value).cast("double").alias("value")
    )


# features --------------------------------------------------------------------------------------

def _efficient() -> dict[str, Column]:
    n, var = F.col("_n").cast("double"), F.col("_var")
    flat = var == 0

    def autocorrelation(lag: int) -> Column:
        return F.when(F.abs(var) > 1e-8, F.try_divide(F.col(f"_auto{lag}"), (n - lag) * var))

    g1 = F.sqrt(F.greatest(n * (n - 1), F.lit(0.0))) * F.try_divide(F.col("_skew"), n - 2)
    g2 = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("_kurt") + 6)
    return {
        "mean": F.col("_mean"),
        "median": F.col("_q")[1],
        "standard_deviation": F.sqrt(var),
        "variance": var,
        "minimum": F.col("_min"),
        "maximum": F.col("_max"),
        "quantile__q_0_25": F.col("_q")[0],
        "quantile__q_0_75": F.col("_q")[2],
        "skewness": F.when(n < 3, F.lit(None)).when(flat, F.lit(0.0)).otherwise(g1),
        "kurtosis": F.when(n < 4, F.lit(None)).when(flat, F.lit(0.0)).otherwise(g2),
        "abs_energy": F.col("_energy"),
        "absolute_sum_of_changes": F.col("_changes"),
        "count_above_mean": F.col("_above").cast("double"),
        "count_below_mean": F.col("_below").cast("double"),
        "linear_trend__attr_slope": F.col("_slope"),
        "autocorrelation__lag_1": autocorrelation(1),
        "autocorrelation__lag_2": autocorrelation(2),
        "c3__lag_1": F.coalesce(F.col("_c3"), F.lit(0.0)),
        "approximate_entropy__m_2__r_0_2": approximate_entropy_of(F.col("_xs")),
    }


def _minimal() -> dict[str, Column]:
    n = F.col("_n")
    return {
        "sum_values": F.col("_sum"),
        "median": F.col("_q")[1],
        "mean": F.col("_mean"),
        "length": n.cast("double"),
        "standard_deviation": F.sqrt(F.col("_var")),
        "variance": F.col("_var"),
        "root_mean_square": F.sqrt(F.col("_energy") / n),
        "maximum": F.col("_max"),
        "absolute_maximum": F.col("_absmax"),
        "minimum": F.col("_min"),
    }


def _longest_run(holds) -> Column:
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(acc, x):
        now = F.when(holds(x), acc["now"] + 1).otherwise(F.lit(0))
        return F.struct(now.alias("now"), F.greatest(acc["best"], now).alias("best"))

    return F.aggregate(F.col("_xs"), start, step, lambda acc: acc["best"].cast("double"))


def _share_beyond(xs: Column, centre: Column, distance: Column, n: Column) -> Column:
    return F.size(F.filter(xs, lambda x: F.abs(x - centre) > distance)) / n


def _extended() -> dict[str, Column]:
    """A larger set: the efficient one and what plain aggregates can add."""
    n, xs, mean = F.col("_n").cast("double"), F.col("_xs"), F.col("_mean")
    std, low, high = F.sqrt(F.col("_var")), F.col("_min"), F.col("_max")
    size = F.col("_n").cast("int")
    extra = {
        "mean_abs_change": F.try_divide(F.col("_changes"), n - 1),
        "mean_change": F.try_divide(F.element_at(xs, -1) - xs[0], n - 1),
        "mean_second_derivative_central": F.when(
            n > 2, F.try_divide(F.element_at(xs, -1) - F.try_element_at(xs, F.lit(-2)) - xs[1] + xs[0], 2 * (n - 2))
        ),
        "cid_ce": F.sqrt(F.col("_changes2")),
        "first_location_of_maximum": (F.array_position(xs, high) - 1) / n,
        "last_location_of_maximum": 1 - (F.array_position(F.reverse(xs), high) - 1) / n,
        "first_location_of_minimum": (F.array_position(xs, low) - 1) / n,
        "last_location_of_minimum": 1 - (F.array_position(F.reverse(xs), low) - 1) / n,
        "longest_strike_above_mean": _longest_run(lambda x: x > mean),
        "longest_strike_below_mean": _longest_run(lambda x: x < mean),
        "number_crossing_m__m_0": F.col("_crossings").cast("double"),
        "variation_coefficient": F.try_divide(std, mean),
        "range_count__min_-1__max_1": F.size(F.filter(xs, lambda x: (x >= -1) & (x < 1))).cast("double"),
        "value_count__value_0": F.size(F.filter(xs, lambda x: x == 0)).cast("double"),
        "has_duplicate": (F.size(F.array_distinct(xs)) < size).cast("double"),
        "has_duplicate_max": (F.size(F.filter(xs, lambda x: x == high)) > 1).cast("double"),
        "has_duplicate_min": (F.size(F.filter(xs, lambda x: x == low)) > 1).cast("double"),
        "time_reversal_asymmetry__lag_1": F.coalesce(F.col("_tras"), F.lit(0.0)),
        "large_standard_deviation__r_0_25": (std > 0.25 * (high - low)).cast("double"),
    }
    for r in ("0_5", "1", "2", "3"):
        bound = float(r.replace("_", "."))
        extra[f"ratio_beyond_r_sigma__r_{r}"] = _share_beyond(xs, mean, bound * std, n)
    repeated = F.filter(
        F.array_distinct(xs), lambda x: F.size(F.filter(F.col("_xs"), lambda y: y == x)) > 1
    )
    extra["sum_of_reoccurring_values"] = F.aggregate(repeated, F.lit(0.0), lambda a, x: a + x)
    extra["sum_of_reoccurring_data_points"] = F.aggregate(
        repeated, F.lit(0.0), lambda a, x: a + x * F.size(F.filter(F.col("_xs"), lambda y: y == x))
    )
    segments = 10
    base, longer = F.floor(size / segments), size % segments
    for i in range(segments):
        begin = base * i + F.least(F.lit(i), longer) + 1
        length = base + F.when(F.lit(i) < longer, 1).otherwise(0)
        chunk = F.slice(xs, begin.cast("int"), length.cast("int"))
        energy = F.aggregate(chunk, F.lit(0.0), lambda a, x: a + x * x)
        extra[f"energy_ratio_by_chunks__num_segments_10__segment_focus_{i}"] = F.try_divide(energy, F.col("_energy"))
    return _efficient() | extra


FEATURE_SETS = {"minimal": _minimal, "efficient": _efficient, "comprehensive": _extended}


def window_features(windows: DataFrame, keys: list[str], kind: str = "efficient") -> DataFrame:
    """One row per window. Windows hold a bounded number of rows, so their helper columns come
    from small windows on the partitioning the rows already have, and one aggregate follows."""
    group = [*keys, "window_id"]
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy("pos")
    v, x = F.col("value"), F.col("pos")
    rows = windows.withColumns(
        {
            "_mu": F.avg(v).over(whole),
            "_1": F.lead(v, 1).over(ordered),
            "_2": F.lead(v, 2).over(ordered),
        }
    )
    mu, one, two = F.col("_mu"), F.col("_1"), F.col("_2")
    facts = rows.groupBy(*group).agg(
        F.count("*").alias("_n"),
        F.sum(v).alias("_sum"),
        F.avg(v).alias("_mean"),
        F.var_pop(v).alias("_var"),
        F.min(v).alias("_min"),
        F.max(v).alias("_max"),
        F.max(F.abs(v)).alias("_absmax"),
        F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.skewness(v).alias("_skew"),
        F.kurtosis(v).alias("_kurt"),
        F.sum(v * v).alias("_energy"),
        F.coalesce(F.sum(F.abs(one - v)), F.lit(0.0)).alias("_changes"),
        F.coalesce(F.sum((one - v) * (one - v)), F.lit(0.0)).alias("_changes2"),
        F.count_if(v > mu).alias("_above"),
        F.count_if(v < mu).alias("_below"),
        F.regr_slope(v, x.cast("double")).alias("_slope"),
        F.sum((v - mu) * (one - mu)).alias("_auto1"),
        F.sum((v - mu) * (two - mu)).alias("_auto2"),
        F.avg(two * one * v).alias("_c3"),
        F.avg(two * two * one - one * v * v).alias("_tras"),
        F.count_if((v > 0) != (one > 0)).alias("_crossings"),
        F.array_sort(F.collect_list(F.struct(x.alias("p"), v.alias("v")))).alias("_pairs"),
    )
    facts = facts.withColumn("_xs", F.transform("_pairs", lambda p: p["v"])).drop("_pairs")
    return facts.select(*group, *[e.alias(PREFIX + n) for n, e in FEATURE_SETS[kind]().items()])


def feature_columns(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c.startswith(PREFIX)]


@nan_is_missing
def impute(features: DataFrame, by: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """+inf becomes the largest finite value of the column, -inf the smallest, NaN and null the
    median; a column without finite values becomes 0. Medians are ranked only for columns with a
    missing cell, which one aggregate tells."""
    by = list(by)
    columns = columns or feature_columns(features)
    inf = float("inf")

    def finite(c):
        return F.when(~F.isnan(c) & (F.abs(F.col(c)) != inf), F.col(c))

    clean = features.select(*by, *[finite(c).alias(c) for c in columns])
    ends = clean.groupBy(*by).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )
    gaps = features.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in columns]).first() if columns else {}
    missing = [c for c in columns if gaps[c]]
    stats = ends
    if missing:
        medians = quantiles(clean.select(*by, *missing), by, missing, [0.5])
        stats = attach(ends, medians.select(*by, *[F.col(c)[0].alias(f"_md_{c}") for c in missing]), by)
    rows = attach(features, stats, by)
    filled = {
        c: F.coalesce(
            F.when(F.col(c) == inf, F.col(f"_hi_{c}")).when(F.col(c) == -inf, F.col(f"_lo_{c}")).otherwise(finite(c)),
            F.col(f"_md_{c}") if c in missing else F.lit(None),
            F.lit(0.0),
        )
        for c in columns
    }
    return rows.withColumns(filled).select(*features.columns)


def constant_columns(features: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Columns whose sample deviation is 0; only one row of statistics reaches the driver."""
    columns = columns or feature_columns(features)
    row = features.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] == 0]


def _clean(features: DataFrame) -> DataFrame:
    """Imputed, without constant columns. One aggregate finds the columns with a cell that is not a finite
    number and the constant ones among the others; only the former are imputed and looked at again."""
    columns = feature_columns(features)
    if not columns:
        return features

    def odd(c):
        return F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))

    row = features.agg(
        F.struct(*[F.count_if(odd(c)).alias(c) for c in columns]).alias("odd"),
        F.struct(*[F.stddev_samp(c).alias(c) for c in columns]).alias("spread"),
    ).first()
    filled = [c for c in columns if row["odd"][c]]
    constant = [c for c in columns if c not in filled and row["spread"][c] == 0]
    if filled:
        features = impute(features, columns=filled)
        constant += constant_columns(features, filled)
    return features.drop(*constant)


def drop_constant(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return features.drop(*constant_columns(features, columns))


def top_features(features: DataFrame, n: int = 20, columns: list[str] | None = None) -> DataFrame:
    """The ``n`` columns with the largest sample variance."""
    columns = columns or feature_columns(features)
    parts = [e for c in columns for e in (F.var_samp(c).alias(f"v_{c}"), F.avg(c).alias(f"m_{c}"))]
    wide = features.agg(*parts)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"v_{c}").alias("variance"),
                F.col(f"m_{c}").alias("mean"),
                F.sqrt(F.col(f"v_{c}")).alias("std"),
            )
            for c in columns
        ]
    )
    return wide.select(F.inline(rows)).orderBy(F.desc_nulls_last("variance"), "feature").limit(n)


@nan_is_missing
def extract_features(
    df: DataFrame,
    keys: list[str],
    data_type: str,
    value: str,
    ts: str,
    order: list[str] | None = None,
    requested: int = 60,
    kind: str = "efficient",
    sliced: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Windows, features, imputation, constant columns removed. Returns the matrix and a report
    per series with its window size, or the reason it has none."""
    if sliced is None:
        sliced = has_large_series(df, keys)
    if data_type == "sleep":
        windows = sleep_windows(df, keys, ts, value, sliced)
    else:
        windows = to_windows(df, keys, value, order or [ts], requested, sliced)
    matrix = stored(window_features(windows, keys, kind), "features")
    matrix = _clean(matrix)
    used = matrix.groupBy(*keys).agg(F.count("*").alias("windows"))
    sizes = df.groupBy(*keys).agg(F.count("*").alias("original_rows"), F.count(value).alias("_known"))
    size = F.lit(requested) if data_type == "sleep" else F.coalesce(window_size(F.col("_known"), requested), F.lit(requested))
    report = attach(sizes, used, keys).select(
        *keys,
        F.lit(data_type).alias("data_type"),
        "original_rows",
        F.lit(requested).alias("requested_window_size"),
        size.alias("window_size"),
        F.coalesce("windows", F.lit(0)).alias("windows"),
        F.lit(len(feature_columns(matrix))).alias("features_extracted"),
        F.col("windows").isNotNull().alias("success"),
        F.when(F.col("windows").isNull(), F.lit(NO_WINDOWS)).alias("error"),
    )
    return matrix, report
