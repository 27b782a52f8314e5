"""Exact duplicates: grouped by a 128-bit content hash, one row stays, bytes are compared in each group.

The bytes of a group meet in one aggregate: its least and its greatest text, combined in every task
before the exchange. They are equal exactly when all texts of the group are. A group in which they
differ holds a collision of the hash and is divided again by the texts themselves. No other step
carries texts: each row is then told its group by its hash and id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.session import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A group with more than one in HOT of all rows is hot; there are fewer than HOT such groups.
HOT = 1000
#: Repeated rows made at once from their count.
COPIES = 100_000


def content_hash(content: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(content))


def normalised(text: Column) -> Column:
    """The bytes that count: null is empty, A-Z become a-z, everything else is as it is."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER).cast("binary")


def _rows(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("content"))
    return bare.withColumn("hash", digest(F.col("content")))


def groups(docs: DataFrame, keep: str = "smallest", digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct text: hash, ``content`` (its bytes where the hash collides, else null),
    keep_id, group_size, text_sha256.

    ``keep`` is ``"smallest"`` or ``"largest"``: which id of equal texts stays. Rows without an id stay
    only where no row of their text has one. An empty table has no groups.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    rows = _rows(docs, digest)
    sums = [pick("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    hashed = stored(
        rows.groupBy("hash")
        .agg(*sums, F.min("content").alias("least"), F.max("content").alias("greatest"))
        .select(
            "hash",
            F.lit(None).cast("binary").alias("content"),
            "keep_id",
            "group_size",
            F.sha2("least", 256).alias("text_sha256"),
            (F.col("least") != F.col("greatest")).alias("collides"),
        ),
        "exact-groups",
    )
    alike = hashed.filter("not collides").drop("collides")
    colliding = hashed.filter("collides").select("hash")
    if colliding.isEmpty():
        return alike
    apart = rows.join(colliding, "hash", "left_semi").groupBy("hash", "content").agg(*sums)
    apart = apart.withColumn("text_sha256", F.sha2("content", 256))
    return alike.unionByName(stored(apart, "exact-collisions"))


def _of_groups(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each row with its group. Hot groups are few and narrow, so they are broadcast; all others hold
    at most one in ``HOT`` of the rows and are joined by hash."""
    plain = found.filter("content is null").drop("content")
    total = found.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") * HOT > F.lit(total)
    hot, rest = F.broadcast(plain.filter(is_hot)), plain.filter(~is_hot)
    at_hot = rows.join(hot, "hash")
    at_rest = rows.join(F.broadcast(plain.filter(is_hot).select("hash")), "hash", "left_anti").join(rest, "hash")
    return at_hot.unionByName(at_rest)


def marked(docs: DataFrame, keep: str = "smallest", digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, dropped ones too.

    Null text equals empty text. Of rows equal in id and text exactly one is kept. Other columns are
    not looked at; an empty table gives an empty result.
    """
    found = groups(docs, keep, digest)
    rows = _rows(docs, digest)
    counted = stored(rows.groupBy("hash", "doc_id").agg(F.count("*").alias("copies")), "exact-rows")
    placed = _of_groups(counted, found)
    collisions = found.filter("content is not null")
    if not collisions.isEmpty():
        exact = rows.join(collisions.select("hash", "content", "keep_id", "group_size", "text_sha256"), ["hash", "content"])
        keys = ["hash", "doc_id", "keep_id", "group_size", "text_sha256"]
        placed = placed.unionByName(exact.groupBy(*keys).agg(F.count("*").alias("copies")))
    lots = placed.withColumn("lot", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    copy = F.explode(F.expr(f"sequence(lot * {COPIES}, least(copies, (lot + 1) * {COPIES}) - 1)"))
    return lots.withColumn("copy", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, keep: str = "smallest", digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows equal in id and text any one
    stays. Whole rows are exchanged once, by hash and id."""
    found = groups(docs, keep, digest).select(
        F.col("hash").alias("_hash"), F.col("content").alias("_content"), F.col("keep_id").alias("_keep")
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    bytes_of = normalised(F.col("_row")["text"])
    keyed = whole.select("_row", digest(bytes_of).alias("_own"), F.col("_row")["doc_id"].cast("long").alias("_id"))
    same = (
        (F.col("_own") == F.col("_hash"))
        & F.col("_id").eqNullSafe(F.col("_keep"))
        & (F.col("_content").isNull() | (F.col("_content") == bytes_of))
    )
    stay = keyed.join(found, same).dropDuplicates(["_hash", "_content", "_id"])
    return stay.select("_row.*")
