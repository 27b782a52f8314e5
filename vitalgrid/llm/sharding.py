"""Contiguous shards of equal byte size, from global prefix sums over per-partition totals.

The rows' keys and sizes (never the texts) are range partitioned once and written to the shared
folder. Each partition reports its bytes and rows; prefix sums over those few totals give every
partition its global start; inside a partition a running sum does the rest. A row belongs to the
shard in which its byte midpoint falls, so every shard is within one row of the target size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.session import stored

SHARDS = 40
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Rows of one partition, at which a running sum is one task's work.
PARTITION_ROWS = 500_000
#: Fewest partitions.
MIN_PARTITIONS = 64


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size and checksum of each row. Null text has no bytes and the checksum of nothing."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )


def balanced(sized: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows of (doc_id, size, text_crc32).

    Order: doc_id with nulls first, then checksum, then size; rows equal in all three are
    interchangeable. ``shard`` = floor(midpoint * shards / all bytes), 0 to shards - 1; ``slot``
    counts from 0 without gaps inside each shard. A hot id is split, since the range partitioning
    also uses checksum and size, and full copies spread by a number of their own. An empty table
    gives an empty result; with fewer bytes than shards some shards are empty.
    """
    key = ["doc_id", "text_crc32", "size", "_copy"]
    parts = sized.count() // PARTITION_ROWS + MIN_PARTITIONS
    laid = (
        sized.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(parts, *key)
        .sortWithinPartitions(*key)
        .drop("_copy")
        .withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()})
    )
    laid = stored(laid, "shard-order")  # from here on partition numbers and positions are fixed

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    totals = laid.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy("_at")
    placed = (
        laid.withColumns(
            {
                "_upto": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                "_row": F.row_number().over(inside),
            }
        )
        .join(starts, "_part")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            # twice the midpoint, so that it is a whole number
            F.expr(f"((2 * (_bytes_before + _upto) - size) * {shards}) div (2 * _all)").cast("int").alias("shard"),
            (F.col("_rows_before") + F.col("_row") - 1).alias("_index"),
        )
    )
    first = placed.groupBy("shard").agg(F.min("_index").alias("_first"))  # at most one row a shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).alias("slot")
    )
