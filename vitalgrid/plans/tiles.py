"""All-to-all comparison of points in tiles.

Points are grouped into tiles of about ``TILE`` points each by a hash of their id, so a tile has a
bounded size whatever the data looks like. A pair of tiles meets in one task row; the evaluator
compares them with numpy and returns sums, minima or a few edges per point, never the pairs.
With ``cells``, only tiles of the same or of touching cells meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 1024


class Tile:
    """Arrays of the points of one tile: id, vec (points × dimensions) and the extra columns."""

    def __init__(self, row, side: str, extras: list[str]):
        self.id = np.asarray(getattr(row, f"{side}_id"))
        self.vec = np.asarray(getattr(row, f"{side}_vec"), dtype=float).reshape(len(self.id), -1)
        for name in extras:
            setattr(self, name, np.asarray(getattr(row, f"{side}_{name}")))


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed per dimension, so equal points are at distance 0 exactly."""
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        total += (a[:, d, None] - b[None, :, d]) ** 2
    return total


def _of_pairs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``squared_distances`` of some pairs, to the last bit."""
    total = np.zeros(len(i))
    for d in range(a.shape[1]):
        total += (a[i, d] - b[j, d]) ** 2
    return total


def _by_product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float] | None:
    """Squared distances by one matrix product, and the largest sum of two squared lengths, to which their error is in
    proportion; none for few dimensions, where it saves nothing, and for numbers that are not finite."""
    if a.shape[1] <= 8 or not len(a) or not len(b):
        return None
    with np.errstate(all="ignore"):
        centre = a.mean(axis=0)
        a, b = a - centre, b - centre
        of_a, of_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
        most = float(of_a.max() + of_b.max())
        if not np.isfinite(most):
            return None
        apart = a @ (-2 * b.T)
    apart += of_a[:, None]
    apart += of_b[None, :]
    return apart, most


def _error(dimensions: int, most: float) -> float:
    """More than a matrix product and a sum by dimension can differ by."""
    return 8 * (dimensions + 16) * np.finfo(float).eps * most


def within(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """``squared_distances(a, b) <= limit``; pairs that a matrix product leaves in doubt are computed one by one."""
    found = _by_product(a, b)
    if found is None:
        return squared_distances(a, b) <= limit
    apart, most = found
    error = _error(a.shape[1], most)
    near = apart <= limit - error
    i, j = np.nonzero((apart <= limit + error) & ~near)
    if 8 * len(i) > near.size:
        return squared_distances(a, b) <= limit
    near[i, j] = _of_pairs(a, b, i, j) <= limit
    return near


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances to about ten digits; equal points are at distance 0 exactly."""
    found = _by_product(a, b)
    if found is None:
        return np.sqrt(squared_distances(a, b))
    apart, most = found
    i, j = np.nonzero(apart < 1e-4 * most)
    if 8 * len(i) > apart.size:
        return np.sqrt(squared_distances(a, b))
    apart[i, j] = _of_pairs(a, b, i, j)
    return np.sqrt(apart, out=apart)


def compare_tiles(
    points: DataFrame,
    evaluate: Callable[[Tile, Tile, bool], dict | None],
    schema: str,
    extras: list[str] = (),
    cells: list[str] = (),
    once: bool = False,
    tile: int = TILE,
    against: DataFrame | None = None,
    near: DataFrame | None = None,
    few: int | None = None,
    apart: str | None = None,
) -> DataFrame:
    """Run ``evaluate(a, b, same)`` for every ordered pair of tiles that may hold neighbours
    (unordered with ``once``). ``points`` has id, vec, the extra columns and integer cell columns.
    With ``against``, its tiles stand on the right side and those of ``points`` on the left. With
    ``near`` (a_cell, b_cell: structs of the cell columns), those pairs of cells meet and no others.
    With ``few``, a tile meets that many tiles of every touching cell instead of all. With ``apart``, points are also
    dealt by that integer column, and points of one value of it do not meet (those with a null meet all)."""
    extras, cells = list(extras), list(cells)
    parts = [*cells, apart] if apart else cells
    cell = F.struct(*parts) if parts else F.struct(F.lit(0).cast("long").alias("all"))

    def dealt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        df = df.withColumn("_cell", cell)
        sizes = df.groupBy("_cell").agg(F.ceil(F.count("*") / F.lit(tile)).cast("long").alias("_tiles"))
        spread = df.join(sizes, "_cell").withColumn("_tile", F.pmod(F.xxhash64("id"), F.col("_tiles")))
        return sizes, spread.groupBy("_cell", "_tile").agg(F.collect_list(F.struct("id", "vec", *extras)).alias("_rows"))

    def field(name: str):
        return F.transform("_rows", lambda r: r[name])

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(
            F.col("_cell").alias(f"{name}_cell"),
            F.col("_tile").alias(f"{name}_tile"),
            field("id").alias(f"{name}_id"),
            F.flatten(field("vec")).alias(f"{name}_vec"),
            *[field(e).alias(f"{name}_{e}") for e in extras],
        )

    left_sizes, left = dealt(points)
    right_sizes, right = (left_sizes, left) if against is None else dealt(against)
    met = left_sizes.select(F.col("_cell").alias("a_cell"), F.col("_tiles").alias("_a"))
    if near is not None:
        met = met.join(near, "a_cell")
    else:
        step = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
        for c in cells:
            met = met.withColumn(f"_d_{c}", F.explode(step))
        for c in cells:
            met = met.withColumn(f"_d_{c}", F.col("a_cell")[c] + F.col(f"_d_{c}"))
    met_by = [] if near is not None else [f"_d_{c}" for c in cells]
    others = right_sizes.select(F.col("_cell").alias("b_cell"), F.col("_tiles").alias("_b"))
    if near is not None:
        met = met.join(others, "b_cell")
    elif met_by:
        met = met.join(others.select("*", *[F.col("b_cell")[c].alias(f"_d_{c}") for c in cells]), met_by).drop(*met_by)
    else:
        met = met.crossJoin(others)
    if apart:
        met = met.filter(~F.coalesce(F.col("a_cell")[apart] == F.col("b_cell")[apart], F.lit(False)))
    met = met.withColumn("a_tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_a") - 1)))
    if few is None:
        met = met.withColumn("b_tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_b") - 1)))
    else:
        step = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(few).cast("long"), F.col("_b")) - 1))
        met = met.withColumn("_step", step).withColumn("b_tile", F.pmod(F.col("a_tile") + F.col("_step"), F.col("_b"))).drop("_step")
    same = (F.col("a_cell") == F.col("b_cell")) & (F.col("a_tile") == F.col("b_tile"))
    if against is not None:
        same = F.lit(False)
    if once:
        place = [F.struct(F.col(f"{s}_cell").alias("cell"), F.col(f"{s}_tile").alias("tile")) for s in "ab"]
        # either order by a hash, so that every tile stands on the right side of about half of its pairs
        swap = F.xxhash64(place[0]).bitwiseXOR(F.xxhash64(place[1])).bitwiseAND(1) == 1
        met = met.filter((place[0] == place[1]) | F.when(swap, place[0] > place[1]).otherwise(place[0] < place[1]))
    pairs = met.withColumn("same", same).drop("_a", "_b")
    pairs = pairs.join(side(left, "a"), ["a_cell", "a_tile"]).join(side(right, "b"), ["b_cell", "b_tile"])
    pairs = pairs.drop("a_cell", "a_tile", "b_cell", "b_tile")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = evaluate(Tile(row, "a", extras), Tile(row, "b", extras), bool(row.same))
                if found is not None:
                    yield pd.DataFrame(found)

    return pairs.mapInPandas(run, schema)
