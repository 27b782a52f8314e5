"""Outlier flags, quality scores and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import OUTLIER_SUFFIX, QUICK_TIMESTAMP_NAMES
from vitalgrid.functions.expressions import nan_is_missing, numeric_columns, share
from vitalgrid.operators.clean import timestamp_checks
from vitalgrid.plans.series import Series, attach, has_large_series, max_series_rows
from vitalgrid.plans.summaries import quantiles, with_quantiles
from vitalgrid.session import checkpointed

#: Most series whose bounds every task may hold.
FEW_SERIES = 100_000


@nan_is_missing
def iqr_bounds(
    df: DataFrame, keys: list[str], columns: list[str], approx: bool = False, sliced: bool | None = None
) -> DataFrame:
    """One row per series with ``c_lower`` and ``c_upper``, 1.5 interquartile ranges outside."""
    q = quantiles(df, keys, columns, [0.25, 0.75], approx, sliced)
    bounds = []
    for c in columns:
        low, high = F.col(c)[0], F.col(c)[1]
        bounds += [
            (low - 1.5 * (high - low)).alias(f"{c}_lower"),
            (high + 1.5 * (high - low)).alias(f"{c}_upper"),
        ]
    return q.select(*keys, *bounds)


def _outside(c: str) -> Column:
    return F.coalesce((F.col(c) < F.col(f"{c}_lower")) | (F.col(c) > F.col(f"{c}_upper")), F.lit(False))


@nan_is_missing
def flag_outliers(
    df: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    approx: bool = False,
    sliced: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows with a ``c_is_outlier`` flag per numeric column, and a report per series and column:
    count, percentage, bounds."""
    columns = columns if columns is not None else numeric_columns(df, exclude=keys)
    if sliced is None:
        sliced = not approx and has_large_series(df, keys, len(columns))
    bounds = iqr_bounds(df, keys, columns, approx, sliced)
    if sliced:  # a join on the keys would sort all rows of a large series in one task
        bounds = checkpointed(bounds)
        if bounds.count() <= FEW_SERIES:
            bounds = F.broadcast(bounds)
    flags = {f"{c}{OUTLIER_SUFFIX}": _outside(c) for c in columns}
    with_bounds = attach(df, bounds, keys).withColumns(flags)
    flagged = with_bounds.select(*df.columns, *flags)
    return flagged, outlier_report(flagged, bounds, keys, columns)


def mark_outliers(series: Series, columns: list[str], approx: bool = False) -> Series:
    """The flags alone, for rows that are already grouped by series."""
    series = with_quantiles(series, columns, [0.25, 0.75], "_q_", approx)
    flags = {}
    for c in columns:
        low, high = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        reach = 1.5 * (high - low)
        flags[f"{c}{OUTLIER_SUFFIX}"] = F.coalesce((F.col(c) < low - reach) | (F.col(c) > high + reach), F.lit(False))
    return series.with_columns(flags).drop(*[f"_q_{c}" for c in columns])


def outlier_report(flagged: DataFrame, bounds: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    counts = flagged.groupBy(*keys).agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"{c}{OUTLIER_SUFFIX}")).alias(f"_{c}") for c in columns]
    )
    both = attach(counts, bounds, keys)
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_{c}").alias("outliers"),
                F.bround(100 * share(F.col(f"_{c}"), F.col("_rows")), 2).alias("percentage"),
                F.col(f"{c}_lower").cast("double").alias("lower"),
                F.col(f"{c}_upper").cast("double").alias("upper"),
            )
            for c in columns
        ]
    )
    return both.select(*keys, F.inline(per_column))


def nulls_in(columns: list[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.count_if(F.col(c).isNull())
    return total


def validation_score(missing_share: Column, issues: Column, outlier_rate: Column) -> Column:
    """0–100 from completeness (0.4), issues (0.05 each off 0.3) and outliers (0.3)."""
    validity = F.greatest(F.lit(0.0), F.lit(0.3) - F.least(issues * F.lit(0.05), F.lit(0.3)))
    return F.bround(100 * ((1 - missing_share) * 0.4 + validity + (1 - outlier_rate) * 0.3), 2)


@nan_is_missing
def quality_scores(
    df: DataFrame, keys: list[str], issues: DataFrame | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Validator score per series of a table that carries outlier flags. ``issues`` holds the
    number of issues per series (column ``issues``)."""
    columns = columns or [c for c in df.columns if c not in keys]
    flags = [c for c in columns if c.endswith(OUTLIER_SUFFIX)]
    outliers = F.lit(0)
    for c in flags:
        outliers = outliers + F.count_if(F.col(c))
    per_series = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), nulls_in(columns).alias("_nulls"), outliers.alias("_outliers")
    )
    if issues is not None:
        per_series = attach(per_series, issues, keys)
    count = F.coalesce(F.col("issues"), F.lit(0)) if issues is not None else F.lit(0)
    rate = share(F.col("_outliers"), F.col("rows") * len(flags)) if flags else F.lit(0.0)
    score = validation_score(share(F.col("_nulls"), F.col("rows") * len(columns)), count, rate)
    return per_series.select(*keys, "rows", count.alias("issues"), score.alias("quality_score"))


def _facts(df: DataFrame, keys: list[str], sliced: bool | None = None) -> tuple[DataFrame, list[str]]:
    """Per series: rows, nulls per column, full-row copies, outliers per numeric column."""
    columns = [c for c in df.columns if c not in keys]
    numbers = numeric_columns(df, exclude=keys)
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    facts = copies.groupBy(*keys).agg(
        F.sum("_copies").alias("_rows"),
        F.sum(F.col("_copies") - 1).alias("_dups"),
        *[F.sum(F.when(F.col(c).isNull(), F.col("_copies")).otherwise(0)).alias(f"_nulls_{c}") for c in columns],
    )
    if numbers:
        bounds = iqr_bounds(df, keys, numbers, sliced=sliced)
        outliers = attach(df.select(*keys, *numbers), bounds, keys).groupBy(*keys).agg(
            *[F.count_if(_outside(c)).alias(f"_out_{c}") for c in numbers]
        )
        facts = attach(facts, outliers, keys)
    return facts, columns


def _total(names: list[str]) -> Column:
    total = F.lit(0)
    for n in names:
        total = total + F.col(n)
    return total


@nan_is_missing
def data_quality_score(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Standalone score: completeness 40, no full-row copies 30, few outliers 30."""
    keys = list(keys)
    facts, columns = _facts(df, keys)
    outs = [c for c in facts.columns if c.startswith("_out_")]
    rows = F.col("_rows")
    completeness = 1 - share(_total([f"_nulls_{c}" for c in columns]), rows * len(columns))
    unique = 1 - share(F.col("_dups"), rows)
    valid = 1 - share(_total(outs), rows * len(outs)) if outs else F.lit(1.0)
    return facts.select(*keys, F.bround(completeness * 40 + unique * 30 + valid * 30, 2).alias("quality_score"))


@nan_is_missing
def quick_check(df: DataFrame) -> DataFrame:
    """One row: validity, issues, warnings and size of a table."""
    numbers = numeric_columns(df)
    has_time = any(c in df.columns for c in QUICK_TIMESTAMP_NAMES)
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    missing = F.lit(0)
    for c in df.columns:
        missing = missing + F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_copies")).otherwise(0)), F.lit(0))
    facts = copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        missing.alias("missing_values"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    warnings = F.array_compact(
        F.array(
            F.when(
                F.col("missing_values") > 0,
                F.concat(F.lit("Total missing values: "), F.col("missing_values").cast("string")),
            ),
            F.when(
                F.col("duplicate_rows") > 0, F.format_string("Found %d duplicate rows", F.col("duplicate_rows"))
            ),
            F.lit(None if numbers else "No numeric columns found").cast("string"),
        )
    )
    issues = F.array(*([] if has_time else [F.lit("No timestamp column found")])).cast("array<string>")
    return facts.select(
        F.lit(has_time).alias("is_valid"),
        issues.alias("issues"),
        warnings.alias("warnings"),
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        "missing_values",
        "duplicate_rows",
        F.lit(len(numbers)).alias("numeric_columns"),
    )


@nan_is_missing
def quality_report(df: DataFrame, keys: list[str] = (), as_of=None) -> DataFrame:
    """Completeness, consistency, accuracy and timeliness, one struct each."""
    keys = list(keys)
    facts, columns = _facts(df, keys)
    rows = F.col("_rows")
    nulls = _total([f"_nulls_{c}" for c in columns])
    numbers = [c[len("_out_"):] for c in facts.columns if c.startswith("_out_")]
    by_column = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(f"_nulls_{c}"))])
    parts = {
        "completeness": F.struct(
            nulls.alias("total_missing"),
            F.bround(100 * share(nulls, rows * len(columns)), 2).alias("missing_percentage"),
            F.map_filter(by_column, lambda _, n: n > 0).alias("columns_with_missing"),
        ),
        "consistency": F.struct(
            F.col("_dups").alias("duplicate_rows"),
            F.bround(100 * share(F.col("_dups"), rows), 2).alias("duplicate_percentage"),
        ),
        "accuracy": F.struct(
            (
                F.create_map(*[x for c in numbers for x in (F.lit(c), F.col(f"_out_{c}"))])
                if numbers
                else F.create_map().cast("map<string,bigint>")
            ).alias("outlier_counts"),
            _total([f"_out_{c}" for c in numbers]).alias("total_outliers"),
        ),
    }
    dated = [c for c in df.columns if "time" in c.lower() or "date" in c.lower()]
    if dated:
        ts = dated[0]
        checks = timestamp_checks("_t", as_of)
        times = df.withColumn("_t", F.col(ts).try_cast("timestamp")).groupBy(*keys).agg(
            F.struct(
                F.count_if(checks["future"]).alias("future_dates"),
                F.count_if(checks["old"]).alias("very_old_dates"),
                F.min("_t").alias("first"),
                F.max("_t").alias("last"),
            ).alias("timeliness")
        )
        facts = attach(facts, times, keys)
        parts["timeliness"] = F.col("timeliness")
    return facts.select(*keys, *[p.alias(n) for n, p in parts.items()])


@nan_is_missing
def column_profile(df: DataFrame, order: list[str] | None = None, approx: bool = False) -> DataFrame:
    """One row per column: type, filled, empty, completeness, distinct values, a sample value
    (the first row's by ``order``).

    The sample is an aggregate of its own: beside it, distinct values would be sorted instead of hashed. A table with
    more values than one task should hold is dealt to more tasks by row before the distinct values are taken."""
    facts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(c).alias(f"_filled_{c}") for c in df.columns],
        F.min_by(F.struct(*df.columns), F.struct(*(order or df.columns))).alias("_sample"),
    )
    if approx:
        distinct = df.agg(*[F.approx_count_distinct(c).alias(f"_distinct_{c}") for c in df.columns])
    else:
        pieces = df.count() * len(df.columns) // max_series_rows(df.sparkSession) + 1
        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
        dealt = df.repartition(pieces, F.xxhash64(*plain)) if pieces > 1 else df
        distinct = dealt.agg(*[F.count_distinct(c).alias(f"_distinct_{c}") for c in df.columns])
    facts = attach(facts, distinct, [])
    rows = F.col("_rows")
    profile = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"_filled_{f.name}").alias("non_null"),
                (rows - F.col(f"_filled_{f.name}")).alias("nulls"),
                (100 * share(F.col(f"_filled_{f.name}"), rows)).alias("completeness_pct"),
                F.col(f"_distinct_{f.name}").alias("unique_values"),
                (100 * share(F.col(f"_distinct_{f.name}"), rows)).alias("uniqueness_pct"),
                F.col(f"_sample.{f.name}").cast("string").alias("sample"),
            )
            for f in df.schema.fields
        ]
    )
    return facts.select(F.inline(profile))


def average_completeness(profile: DataFrame) -> DataFrame:
    return profile.agg(F.avg("completeness_pct").alias("avg_completeness"))
