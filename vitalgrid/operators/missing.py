"""Missing values: interpolation and the fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import BACKFILL_LIMIT, INTERPOLATE_LIMIT
from vitalgrid.functions.expressions import NUMERIC, micros, nan_is_missing, numeric_columns
from vitalgrid.plans.series import Series, attach
from vitalgrid.plans.summaries import with_mode, with_quantiles


def _surrounded(series: Series, columns: list[str], at) -> Series:
    """Add ``_b_c`` and ``_a_c``: the nearest known (value, place) up to and from each row."""
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), at.alias("p"))) for c in columns}
    return series.known(
        before={f"_b_{c}": e for c, e in known.items()},
        after={f"_a_{c}": e for c, e in known.items()},
    )


def _between(c: str, at):
    b, a = F.col(f"_b_{c}"), F.col(f"_a_{c}")
    part = F.try_divide((at - b["p"]).cast("double"), (a["p"] - b["p"]).cast("double"))
    return b["v"] + (a["v"] - b["v"]) * part


def interpolate_rows(
    series: Series, columns: list[str], limit: int = INTERPOLATE_LIMIT, backfill: int = BACKFILL_LIMIT
) -> Series:
    """Linear interpolation by row position: the first ``limit`` rows of a gap; a trailing gap
    repeats the last value; then the last ``backfill`` rows of what is left take the next value."""
    if not columns:
        return series
    pos = F.col("_pos")
    series = _surrounded(series.position("_pos"), columns, pos)
    filled = {}
    for c in columns:
        b, a = F.col(f"_b_{c}"), F.col(f"_a_{c}")
        forward = F.when(a.isNull(), b["v"].cast("double")).otherwise(_between(c, pos))
        filled[c] = F.coalesce(
            F.col(c).cast("double"),
            F.when(pos - b["p"] <= limit, forward),
            F.when(a["p"] - pos <= backfill, a["v"].cast("double")) if backfill else F.lit(None),
        )
    return series.with_columns(filled).drop("_pos", *[f"_{s}_{c}" for c in columns for s in "ab"])


def interpolate_time(series: Series, columns: list[str], ts: str) -> Series:
    """Time-weighted interpolation without a limit; the ends take the nearest value."""
    if not columns:
        return series
    at = micros(ts)
    series = _surrounded(series, columns, at)
    filled = {
        c: F.coalesce(F.col(c).cast("double"), _between(c, at), F.col(f"_b_{c}")["v"], F.col(f"_a_{c}")["v"])
        for c in columns
    }
    return series.with_columns(filled).drop(*[f"_{s}_{c}" for c in columns for s in "ab"])


def forward_fill(series: Series, columns: list[str]) -> Series:
    return series.known(before={c: F.col(c) for c in columns}) if columns else series


def backward_fill(series: Series, columns: list[str]) -> Series:
    return series.known(after={c: F.col(c) for c in columns}) if columns else series


@nan_is_missing
def zero_fill(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Zero for numbers, false for flags; text stays as it is."""
    fills = {}
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        if isinstance(f.dataType, NUMERIC):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.BooleanType):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(False))
    return df.withColumns(fills) if fills else df


def median_fill(series: Series, columns: list[str], approx: bool = False) -> Series:
    series = with_quantiles(series, columns, [0.5], "_median_", approx)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}")[0]) for c in columns}
    return series.with_columns(filled).drop(*[f"_median_{c}" for c in columns])


def mode_fill(series: Series, columns: list[str], default: str = "unknown") -> Series:
    """The most frequent value; text without any value becomes ``default``."""
    for c in columns:
        series = with_mode(series, c, f"_mode_{c}")
        fills = [F.col(c), F.col(f"_mode_{c}")]
        if isinstance(series.df.schema[c].dataType, T.StringType):
            fills.append(F.lit(default))
        series = series.with_columns({c: F.coalesce(*fills)})
    return series.drop(*[f"_mode_{c}" for c in columns])


def strategies(df: DataFrame, keys: list[str], ts: str, order: list[str] = ()) -> dict[str, str]:
    """How each column is filled."""
    chosen = {}
    for f in df.schema.fields:
        if f.name in keys or (f.name in order and f.name != ts):
            continue
        if f.name == ts:
            chosen[f.name] = "dropped"
        elif f.name in ("heart_rate", "step_count"):
            chosen[f.name] = "interpolation + backfill"
        elif f.name == "sleep_stage":
            chosen[f.name] = "forward fill"
        elif isinstance(f.dataType, NUMERIC):
            chosen[f.name] = "median"
        elif isinstance(f.dataType, (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            chosen[f.name] = "mode"
    return chosen


@nan_is_missing
def null_counts(df: DataFrame, keys: list[str], columns: list[str], prefix: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in columns])


def handle_missing(
    df: DataFrame,
    keys: list[str],
    ts: str,
    order: list[str] | None = None,
    how: dict[str, str] | None = None,
    sliced: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fill every column by its strategy. Returns the rows and a report: null counts per series
    and column before and after, with the strategy used where something was missing."""
    how = how if how is not None else strategies(df, keys, ts, order or [])
    series = Series.of(df.filter(F.col(ts).isNotNull()), keys, order or [ts], sliced)
    filled = fill_missing(series, how).done()
    return filled, missing_report(df, filled, keys, how)


def fill_missing(series: Series, how: dict[str, str]) -> Series:
    pick = lambda name: [c for c, s in how.items() if s == name]
    series = interpolate_rows(series, pick("interpolation + backfill"))
    series = forward_fill(series, pick("forward fill"))
    series = median_fill(series, pick("median"))
    return mode_fill(series, pick("mode"))


def missing_report(before: DataFrame, after: DataFrame, keys: list[str], how: dict[str, str]) -> DataFrame:
    columns = list(how)

    def long(df: DataFrame, name: str) -> DataFrame:
        return null_counts(df, keys, columns, "").unpivot(keys, columns, "column", name)

    both = attach(long(before, "missing_before"), long(after, "missing_after"), [*keys, "column"])
    rule = F.create_map(*[F.lit(x) for pair in how.items() for x in pair])
    return both.withColumn(
        "strategy", F.when(F.col("missing_before") > 0, rule[F.col("column")])
    ).withColumn("missing_after", F.coalesce("missing_after", F.lit(0)))


def fill_gaps(series: Series, method: str, ts: str, columns: list[str] | None = None) -> Series:
    """Gaps left by resampling: ``interpolate`` (numbers, by time), ``forward_fill``,
    ``backward_fill`` or ``zero``; any other name leaves them."""
    everything = [c for c in series.columns if c not in (*series.keys, ts, *series.order)]
    if method == "interpolate":
        numbers = columns if columns is not None else numeric_columns(series.df.select(*everything))
        return interpolate_time(series, numbers, ts)
    if method == "forward_fill":
        return forward_fill(series, everything)
    if method == "backward_fill":
        return backward_fill(series, everything)
    if method == "zero":
        return series.on(zero_fill(series.df, everything))
    return series
