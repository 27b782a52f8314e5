"""Ordered work over many series, safe for a series that holds a large part of all rows.

Rows of one series are ordered by time, and most operators look at neighbours: the last known
value, the row before, the running position. A plain window keeps a whole series in one task.
``Series`` first counts rows per series (a pre-aggregated count over the key columns). While
all series fit one task it uses plain windows: one exchange on the keys, shared by all windows
that follow. Otherwise the table is range partitioned on (keys, order), so a long series is cut
into slices of ``SLICE_ROWS`` rows at most (or ``max_rows``, if less); the cut table is written once to the shared folder;
windows run inside a slice, and what must cross a cut (last known value, row counts) travels in
one summary row per slice.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.functions.expressions import nan_to_null
from vitalgrid.session import stored

MAX_ROWS_CONF = "spark.vitalgrid.maxSeriesRows"
MAX_ROWS = 2_000_000
#: Rows of one slice at most, also where a whole series may have more: a task sorts its rows several times.
SLICE_ROWS = 100_000

_HELPERS = ["_k", "_slice", "_at"]


def max_series_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_ROWS_CONF, str(MAX_ROWS)))


def has_large_series(df: DataFrame, keys: list[str], values_per_row: int = 1) -> bool:
    """Whether any series has more rows (times values per row) than one task should hold."""
    limit = max_series_rows(df.sparkSession) // max(1, values_per_row)
    return not df.groupBy(*keys).count().filter(F.col("count") > limit).isEmpty()


def attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Add per-series statistics (one row per series) to the rows of ``df``.

    A plain left join: adaptive execution broadcasts the statistics when their measured size is
    small and splits the partitions of a hot series otherwise. Without keys the single row of
    statistics comes in as a scalar subquery.
    """
    if not keys:
        picked = stats.select(F.struct(*stats.columns)).scalar().alias("_stats")
        return df.select("*", picked).select(*df.columns, "_stats.*")
    renamed = stats.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[c for c in stats.columns if c not in keys],
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return df.join(renamed, condition, "left").drop(*[f"_right_{k}" for k in keys])


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash partition by key into the configured number of partitions. For Python work per series:
    without a number, adaptive execution would put many small series into one Python task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


@dataclass(frozen=True)
class Series:
    df: DataFrame
    keys: list[str]
    order: list[str]
    sliced: bool

    @classmethod
    def of(cls, df: DataFrame, keys, order, sliced: bool | None = None) -> "Series":
        """``order`` must be unique inside a series for repeatable results. NaN counts as null."""
        keys, order = list(keys), list(order)
        df = nan_to_null(df)
        if sliced is None:
            sliced = has_large_series(df, keys)
        if sliced:
            df = _cut(df, keys, order)
        return cls(df, keys, order, sliced)

    # windows ---------------------------------------------------------------------------------

    @property
    def group(self) -> list[str]:
        """Columns that identify a group of bounded size: the series, or a slice of it."""
        return ["_k", "_slice"] if self.sliced else self.keys

    @property
    def by(self) -> list[str]:
        return ["_at"] if self.sliced else self.order

    @property
    def window(self):
        return Window.partitionBy(*self.group).orderBy(*self.by)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c not in _HELPERS]

    @property
    def backwards(self):
        """From the last row to the first. A running frame over it is linear, while a frame from
        the current row to the end recomputes every row's remainder."""
        return Window.partitionBy(*self.group).orderBy(*[F.desc_nulls_last(c) for c in self.by])

    def on(self, df: DataFrame) -> "Series":
        return replace(self, df=df)

    def select(self, *columns) -> "Series":
        kept = [c for c in _HELPERS if c in self.df.columns]
        return self.on(self.df.select(*columns, *kept))

    def with_columns(self, columns: dict) -> "Series":
        return self.on(self.df.withColumns(columns)) if columns else self

    def drop(self, *columns) -> "Series":
        return self.on(self.df.drop(*columns))

    def filter(self, condition: Column) -> "Series":
        return self.on(self.df.filter(condition))

    def done(self) -> DataFrame:
        return self.df.drop(*_HELPERS)

    # steps -----------------------------------------------------------------------------------

    def position(self, name: str) -> "Series":
        """0-based row number inside the series."""
        if not self.sliced:
            return self.with_columns({name: F.row_number().over(self.window).cast("long") - 1})
        spans = self._per_slice(F.count("*").alias("_n"), F.min("_at").alias("_start"))
        spans = spans.withColumn("_offset", F.coalesce(F.sum("_n").over(_earlier()), F.lit(0)))
        df = self._join_slices(spans.drop("_n"))
        df = df.withColumn(name, F.col("_at") - F.col("_start") + F.col("_offset"))
        return self.on(df.drop("_start", "_offset"))

    def size(self, name: str) -> "Series":
        """Number of rows of the series."""
        return self.stats({name: F.count("*")})

    def stats(self, aggregates: dict) -> "Series":
        """Add aggregates over the whole series to its rows. Bounded series use an unordered window
        on the partitioning they already have; large ones a pre-aggregated join."""
        if not self.sliced:
            whole = Window.partitionBy(*self.keys)
            return self.with_columns({n: e.over(whole) for n, e in aggregates.items()})
        summary = self.df.groupBy(*self.keys).agg(*[e.alias(n) for n, e in aggregates.items()])
        return self.on(attach(self.df, summary, self.keys))

    def known(self, before: dict | None = None, after: dict | None = None) -> "Series":
        """Last non-null value up to this row (``before``), first one from this row on (``after``)."""
        before, after = before or {}, after or {}
        so_far = (Window.unboundedPreceding, Window.currentRow)
        local = {n: F.last(e, ignorenulls=True).over(self.window.rowsBetween(*so_far)) for n, e in before.items()}
        local |= {n: F.last(e, ignorenulls=True).over(self.backwards.rowsBetween(*so_far)) for n, e in after.items()}
        if not self.sliced:
            return self.with_columns(local)
        at = F.col("_at")
        edges = self._per_slice(
            *[F.max_by(e, F.when(e.isNotNull(), at)).alias(f"_in_{n}") for n, e in before.items()],
            *[F.min_by(e, F.when(e.isNotNull(), at)).alias(f"_in_{n}") for n, e in after.items()],
        ).withColumns(
            {f"_in_{n}": F.last(f"_in_{n}", ignorenulls=True).over(_earlier()) for n in before}
            | {f"_in_{n}": F.last(f"_in_{n}", ignorenulls=True).over(_later()) for n in after}
        )
        df = self._join_slices(edges)
        df = df.withColumns({n: F.coalesce(e, F.col(f"_in_{n}")) for n, e in local.items()})
        return self.on(df.drop(*[f"_in_{n}" for n in local]))

    def neighbours(self, previous: dict | None = None, following: dict | None = None) -> "Series":
        """Values of the row before and of the row after; null at the ends of the series."""
        previous, following = previous or {}, following or {}
        if not self.sliced:
            return self.with_columns(
                {n: F.lag(e).over(self.window) for n, e in previous.items()}
                | {n: F.lead(e).over(self.window) for n, e in following.items()}
            )
        at = F.col("_at")
        steps = []
        if previous:
            steps.append(("_row_before", previous, F.lag, F.max_by))
        if following:
            steps.append(("_row_after", following, F.lead, F.min_by))
        packed = {tag: F.struct(*[e.alias(n) for n, e in exprs.items()]) for tag, exprs, _, _ in steps}
        edges = self._per_slice(*[edge(packed[tag], at).alias(f"{tag}_edge") for tag, _, _, edge in steps])
        slices = Window.partitionBy("_k").orderBy("_slice")
        edges = edges.withColumns({f"{tag}_edge": shift(f"{tag}_edge").over(slices) for tag, _, shift, _ in steps})
        df = self._join_slices(edges)
        df = df.withColumns(
            {tag: F.coalesce(shift(packed[tag]).over(self.window), F.col(f"{tag}_edge")) for tag, _, shift, _ in steps}
        )
        df = df.withColumns({n: F.col(f"{tag}.{n}") for tag, exprs, _, _ in steps for n in exprs})
        return self.on(df.drop(*[c for tag, *_ in steps for c in (tag, f"{tag}_edge")]))

    def running_total(self, name: str, amount: Column) -> "Series":
        """Sum of ``amount`` from the first row of the series up to this one."""
        up_to = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = F.sum(amount).over(up_to)
        if not self.sliced:
            return self.with_columns({name: local})
        sums = self._per_slice(F.sum(amount).alias("_sum"))
        sums = sums.withColumn("_sum", F.coalesce(F.sum("_sum").over(_earlier()), F.lit(0)))
        df = self._join_slices(sums).withColumn(name, local + F.col("_sum"))
        return self.on(df.drop("_sum"))

    def _per_slice(self, *aggregates) -> DataFrame:
        return self.df.groupBy("_k", "_slice").agg(*aggregates)

    def _join_slices(self, summary: DataFrame) -> DataFrame:
        return self.df.join(summary, ["_k", "_slice"], "left")


def _earlier():
    return Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def _later():
    return Window.partitionBy("_k").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)


def _cut(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Sort the table across tasks and write it once. ``_at`` numbers the rows in sort order
    (partition in the high bits), ``_slice`` is the partition, ``_k`` the key as one value that
    compares equal on nulls. Rows equal in keys and order are ordered by a hash of the row; full
    copies, which are interchangeable, still spread by their input number."""
    pieces = df.count() // min(max_series_rows(df.sparkSession), SLICE_ROWS) + 1
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    sort = [*keys, *order, "_hash", "_copy"]
    laid = (
        df.withColumns({"_hash": F.xxhash64(*plain), "_copy": F.monotonically_increasing_id()})
        .repartitionByRange(pieces, *sort)
        .sortWithinPartitions(*sort)
        .drop("_hash", "_copy")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    laid = stored(laid, "slices")
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    laid = laid.withColumns({"_k": key, "_slice": F.shiftright("_at", 33)})
    # with a number, adaptive execution does not put many slices into one task
    return laid.repartition(2 * pieces, "_k", "_slice")
