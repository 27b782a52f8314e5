"""Hard negatives by Fagin's threshold algorithm.

Rows are laid out once by label into blocks of bounded size. A unit of work is one block and a bounded
number of anchors. It sorts the block's rows once for each dimension; an anchor then reads these lists
from the end that its entry's sign favours, all lists equally deep, and scores each row it meets with
the whole integer product. The threshold, the product of the anchor with the last values read, bounds the
score of every row not met yet. Reading stops when the threshold lies strictly below the last place
of everything that is asked, so that ties are still met.

First each anchor's best rows of its own label, from the blocks that hold it; then, for each such
positive, the best rows of other labels inside its window of scores, from all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.session import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 80, 100

#: Rows of one block, about, and most anchors of one unit of work, about.
BLOCK_ROWS = 16_384
UNIT_ANCHORS = 8_192
#: Depth read from each list before the threshold is asked for the first time; doubled each time.
FIRST_DEPTH = 16
#: Parts in which the anchors of one label look up its blocks.
SALTS = 16

_EXACT = 1 << 53
_MOST = (1 << 63) - 1


def laid_out(vectors: DataFrame, anchor: Column) -> DataFrame:
    """Rows that take part, in blocks: row (a number of its own), vec_id, label, embedding, is_anchor,
    block. Rows without an id, a label or a vector, or with a null or non-finite entry, take no
    part. Rows of one label lie in neighbouring blocks; a frequent label fills many."""
    bare = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    )
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = bare.filter("vec_id is not null and label is not null and embedding is not null").filter(~bad)
    blocks = max(1, -(-whole.count() // BLOCK_ROWS))
    whole = whole.withColumns({"dim": F.size("embedding"), "_deal": F.monotonically_increasing_id()})
    ordered = whole.repartitionByRange(blocks, "dim", "label", F.xxhash64("vec_id", "_deal")).drop("_deal")
    return stored(
        ordered.withColumns({"block": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "negatives-rows"
    )


class Lists:
    """Integer vectors of some rows, and for each dimension their order and their sorted values."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.argsort(x, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(x.T, self.order, axis=1)

    def walk(self, q: np.ndarray, first: int = FIRST_DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray, float | None]]:
        """Rows met, their scores, and the most that a row not met yet can score (None: all are met)."""
        n = len(self.x)
        if not n:
            return
        high, low = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        if not len(high) + len(low):  # every score is zero
            yield np.arange(n), self.x @ q, None
            return
        met, depth, step = np.zeros(n, bool), 0, first
        left = n
        while left:
            end = min(n, depth + step)
            at = np.concatenate([self.order[high, n - end : n - depth].ravel(), self.order[low, depth:end].ravel()])
            fresh = np.zeros(n, bool)
            fresh[at] = True
            fresh &= ~met
            rows = np.flatnonzero(fresh)
            met[rows] = True
            left -= len(rows)
            bound = q[high] @ self.sorted[high, n - end] + q[low] @ self.sorted[low, end - 1]
            yield rows, self.x[rows] @ q, bound if left else None
            depth, step = end, step * 2


def best(lists: Lists, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: int, count: int) -> list[tuple[int, int]]:
    """(score, position) of the ``count`` best rows, ties by smaller id, without the anchor's own row."""
    places, scores = np.zeros(0, np.int64), np.zeros(0, lists.x.dtype)
    for met, score, bound in lists.walk(q):
        other = rows[met] != own
        places, scores = np.concatenate([places, met[other]]), np.concatenate([scores, score[other]])
        if len(scores) > count:
            keep = _first(scores, ids[places], rows[places], count)
            places, scores = places[keep], scores[keep]
        if bound is not None and len(scores) == count and bound < scores.min():
            break
    keep = _first(scores, ids[places], rows[places], count)
    return [(int(scores[i]), int(places[i])) for i in keep]


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Positions of the first ``count`` by falling score, then id, then row."""
    at = np.arange(len(scores))
    if len(scores) > 4 * count:  # only those from the last place up need sorting
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - count)[len(scores) - count])
    return at[np.lexsort((rows[at], ids[at], -scores[at]))[:count]]


def in_windows(
    lists: Lists, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], count: int
) -> list[list[tuple[int, int]]]:
    """For every window (least and greatest score) the ``count`` best allowed rows inside it."""
    wanted = [w for w in windows if w[0] <= w[1]]
    if not wanted:
        return [[] for _ in windows]
    least, greatest = min(w[0] for w in wanted), max(w[1] for w in wanted)
    places, scores = np.zeros(0, np.int64), np.zeros(0, lists.x.dtype)
    for met, score, bound in lists.walk(q):
        some = allowed[met] & (score >= least) & (score <= greatest)
        places, scores = np.concatenate([places, met[some]]), np.concatenate([scores, score[some]])
        if bound is None or all(_settled(scores, w, count, bound) for w in wanted):
            break
    out = []
    for low, high in windows:
        at = np.flatnonzero((scores >= low) & (scores <= high))
        keep = at[_first(scores[at], ids[places[at]], rows[places[at]], count)]
        out.append([(int(scores[i]), int(places[i])) for i in keep])
    return out


def _settled(scores: np.ndarray, window: tuple[int, int], count: int, bound) -> bool:
    """Whether no row not met yet can take a place in the window."""
    if bound < window[0]:
        return True
    inside = scores[(scores >= window[0]) & (scores <= window[1])]
    return len(inside) >= count and bound < np.partition(inside, len(inside) - count)[len(inside) - count]


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    """Entries as whole numbers: doubles, in which all their products are exact, else Python integers."""
    flat = column.combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays(flat.chunks).flatten()
    return np.floor(SCALE * flat.to_numpy(zero_copy_only=False)).reshape(-1, d)


def _exact(*matrices: np.ndarray) -> list[np.ndarray]:
    top = [max(float(np.abs(m).max()), 1.0) if m.size else 1.0 for m in matrices]
    if max(top) ** 2 * matrices[0].shape[1] < _EXACT:
        return list(matrices)
    whole = np.vectorize(int, otypes=[object])
    return [whole(m) if m.size else m.astype(object) for m in matrices]


def _long(value: int) -> int:
    return max(-_MOST - 1, min(_MOST, value))


def _by_dim(block: pa.Table, anchors: pa.Table) -> Iterator[tuple[pa.Table, pa.Table, int]]:
    dims = block.column("dim").to_numpy()
    wanted = anchors.column("dim").to_numpy()
    for d in np.unique(wanted):
        if d and (dims == d).any():
            yield block.filter(pa.array(dims == d)), anchors.filter(pa.array(wanted == d)), int(d)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


POSITIVE = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long"


def _find_positives(count: int):
    def run(block: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and anchors.num_rows:
            for part, asking, d in _by_dim(block, anchors):
                x, q = _exact(_matrix(part.column("embedding"), d), _matrix(asking.column("embedding"), d))
                label, asked = _numbers(part, "label"), _numbers(asking, "label")
                ids, rows = _numbers(part, "vec_id"), _numbers(part, "row")
                a_ids, a_rows = _numbers(asking, "vec_id"), _numbers(asking, "row")
                for own in np.unique(asked):
                    at = np.flatnonzero(label == own)
                    lists = Lists(x[at])
                    for i in np.flatnonzero(asked == own):
                        for score, place in best(lists, q[i], ids[at], rows[at], a_rows[i], count):
                            out.append((a_rows[i], a_ids[i], rows[at[place]], ids[at[place]], _long(score)))
        return _table(out, POSITIVE)

    return run


NEGATIVE = f"{POSITIVE}, negative_row long, negative_id long, negative_score long"


def _find_negatives(count: int, low: int, high: int):
    def run(block: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and anchors.num_rows:
            for part, asking, d in _by_dim(block, anchors):
                x, q = _exact(_matrix(part.column("embedding"), d), _matrix(asking.column("embedding"), d))
                label, asked = _numbers(part, "label"), _numbers(asking, "label")
                ids, rows = _numbers(part, "vec_id"), _numbers(part, "row")
                a_ids, a_rows = _numbers(asking, "vec_id"), _numbers(asking, "row")
                lists = Lists(x)
                other = {own: label != own for own in np.unique(asked)}
                for i, positives in enumerate(asking.column("positives").to_pylist()):
                    windows = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in positives]
                    found = in_windows(lists, q[i], ids, rows, other[asked[i]], windows, count)
                    for p, negatives in zip(positives, found):
                        about = (a_rows[i], a_ids[i], p["positive_row"], p["positive_id"], p["positive_score"])
                        out += [(*about, rows[place], ids[place], _long(score)) for score, place in negatives]
        return _table(out, NEGATIVE)

    return run


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [part.split()[0] for part in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table({name: pa.array([int(v) for v in values], pa.int64()) for name, values in zip(names, columns)})


def _in_units(rows: DataFrame, anchors: DataFrame, units: int, work, schema: str) -> DataFrame:
    """Run ``work`` on every block with the anchors that ask it, ``units`` groups of them apart."""
    unit = F.pmod(F.xxhash64("row"), F.lit(units)).cast("int")
    left = rows.select("block", "row", "vec_id", "label", "dim", "embedding", F.explode(F.sequence(F.lit(0), F.lit(units - 1))).alias("unit"))
    asking = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], unit.alias("unit"))  # columns of their own
    return left.groupBy("block", "unit").cogroup(asking.groupBy("block", "unit")).applyInArrow(work, schema)


def _ranked(found: DataFrame, keys: list[str], kind: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(f"{kind}_score"), f"{kind}_id", f"{kind}_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def positives(rows: DataFrame, count: int = POSITIVES) -> DataFrame:
    """The first ``count`` other rows of the same label, for every anchor of ``laid_out`` rows; all of
    them if there are fewer. Only vectors of equally many entries meet."""
    anchors = rows.filter("is_anchor").drop("block", "is_anchor")
    units = max(1, -(-anchors.count() // UNIT_ANCHORS))
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    spread = rows.groupBy("dim", "label").agg(F.min("block").alias("first"), F.max("block").alias("last")).select("*", salt)
    asking = (
        anchors.withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)).cast("int"))
        .join(spread, ["dim", "label", "salt"])
        .withColumn("block", F.explode(F.sequence("first", "last")))
        .drop("first", "last", "salt")
    )
    found = _in_units(rows, asking, units, _find_positives(count), POSITIVE)
    return _ranked(found, ["anchor_row"], "positive", count).drop("rank")


def mine(
    vectors: DataFrame, anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; rows for which ``anchor`` holds are the anchors. A score is
    the inner product of floor(256 * x) entries. For every anchor and each of its positives, the first
    ``n_negatives`` rows of another label with low * positive <= 100 * negative <= high * positive; higher
    scores first, then smaller ids. Rows with an equal id are rows of their own. A negative positive_score has
    an empty window. Scores beyond a long count as the last long. An empty table gives no rows.
    """
    rows = laid_out(vectors, anchor)
    blocks = rows.agg(F.max("block")).first()[0]
    own = stored(positives(rows, n_positives), "negatives-positives")
    asked = own.groupBy("anchor_row").agg(F.collect_list(F.struct("positive_row", "positive_id", "positive_score")).alias("positives"))
    anchors = rows.filter("is_anchor").drop("block", "is_anchor").join(asked, F.col("row") == F.col("anchor_row")).drop("anchor_row")
    units = max(1, -(-rows.filter("is_anchor").count() // UNIT_ANCHORS))
    everywhere = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks or 0))))
    found = _in_units(rows, everywhere, units, _find_negatives(n_negatives, low, high), NEGATIVE)
    best_ones = _ranked(found, ["anchor_row", "positive_row"], "negative", n_negatives)
    return best_ones.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
