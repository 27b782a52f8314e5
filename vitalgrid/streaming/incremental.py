"""The row-wise checks and the resampling of files as they arrive, with Structured Streaming.

The operators are those of the batch modules; only what needs no whole series runs on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.operators.anomaly import flag_thresholds
from vitalgrid.operators.clean import clip_ranges, drop_bad_timestamps

_BINNED = {
    "mean": lambda c, ts: F.avg(c),
    "sum": lambda c, ts: F.coalesce(F.sum(c), F.lit(0)),
    "min": lambda c, ts: F.min(c),
    "max": lambda c, ts: F.max(c),
    "first": lambda c, ts: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ts))),
    "last": lambda c, ts: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ts))),
}


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def checked_stream(stream: DataFrame, ts: str, value: str, rule: tuple, as_of=None, ranges: dict | None = None) -> DataFrame:
    """Drop rows with a bad time, clip ranges, flag values beyond the rule's limits row by row."""
    low, high = rule[:2]
    rows = clip_ranges(drop_bad_timestamps(stream, ts, as_of), ranges)
    return flag_thresholds(rows, [], "stream", [ts], value, (low, high, 0))


def resample_stream(
    stream: DataFrame, keys: list[str], ts: str, seconds: int, how: dict[str, str], late: str = "1 hour"
) -> DataFrame:
    """Bins of ``seconds`` per series; a bin is final once the data is ``late`` past its end.
    ``ts`` must be a TIMESTAMP."""
    bins = stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("_w"))
    rows = bins.agg(*[_BINNED[h](c, ts).alias(c) for c, h in how.items()])
    return rows.select(*keys, F.col("_w.start").alias(ts), *how)


def write_available(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived and stop; the next call goes on from the checkpoint."""
    writer = rows.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(path).awaitTermination()
