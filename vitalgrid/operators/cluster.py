"""Clustering of feature vectors and its quality measures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.catalog import TOO_FEW_ROWS
from vitalgrid.functions.expressions import share
from vitalgrid.plans.series import Series, attach
from vitalgrid.plans.tiles import TILE, compare_tiles, distances, within
from vitalgrid.session import checkpointed, stored

SEED = 42
RESTARTS = 10
TOLERANCE = 1e-4
ROWS_PER_TASK = 10_000
#: Centres that a row is compared with at a time.
CENTRES = 256
MAX_ITERATIONS = 300
#: Core points of a small cell that are linked one by one; more are put into boxes.
FEW = 64
#: Boxes across a small cell, per dimension.
PARTS = 4
#: Points a cell on average from which tiles first meet a few others only.
CROWDED = 4 * TILE
#: Most points of a tile of the exact silhouette, sums that a pair of tiles returns, and points compared at a time.
LARGE_TILE = 16_384
MOST_SUMS = 8_000_000
BLOCK = 512


def standardize(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Zero mean, unit population deviation per column; a constant column is only centred."""
    by = list(by)
    stats = df.groupBy(*by).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns]
    )
    scaled = {
        c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}"))
        for c in columns
    }
    return attach(df, stats, by).withColumns(scaled).select(*df.columns)


def with_vector(df: DataFrame, columns: list[str], name: str = "vec") -> DataFrame:
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in columns]))


def kmeans(
    points: DataFrame,
    k: int = 3,
    seed: int = SEED,
    restarts: int = RESTARTS,
    vec: str = "vec",
    id: str | None = None,
    max_iterations: int = MAX_ITERATIONS,
) -> tuple[DataFrame, DataFrame]:
    """K-means on an array column, best of several starts. Returns the rows with ``cluster`` and a
    one-row report, which tells whether the best fit converged within ``max_iterations``. ``k`` shrinks
    to the number of rows. With ``id``, clusters are numbered by their smallest id, so the numbers do
    not depend on the start.

    All starts share their passes over the rows. A pass of the seeding draws the next centre of every start
    with a probability in proportion to the squared distance from those it has; a pass of the fit adds up,
    per task and then over all tasks, the rows of every cluster of every start. A start has converged when
    its centres move by less than ``TOLERANCE`` of the mean variance.
    """
    data = points.select(F.transform(vec, lambda x: x.cast("double")).alias("vec"), F.monotonically_increasing_id().alias("row"))
    data = stored(data, "kmeans")
    rows = data.count()
    blocks = rows // ROWS_PER_TASK + 1
    used = min(k, rows)
    session = points.sparkSession
    if rows < 2:
        labels = points.withColumn("cluster", F.lit(0))
        inertia, iterations, converged = 0.0, 0, True
    else:
        fitted = data.repartition(blocks).persist()
        solve = _solve_block if blocks == 1 else _solve
        centres, costs, steps, settled = solve(fitted, used, restarts, seed, max_iterations)
        fitted.unpersist()
        best = int(np.argmin(costs))
        labels = points.withColumn("cluster", _nearest(F.col(vec), centres[best]))
        inertia, iterations, converged = float(costs[best]), int(steps[best]), bool(settled[best])
        if id is not None:
            labels = _numbered(labels, id)
    report = session.createDataFrame(
        [(inertia, iterations, converged, k, used)],
        "inertia double, n_iterations int, converged boolean, requested_clusters int, actual_clusters int",
    )
    return labels, report


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to the centres of all starts: rows, starts, clusters. A centre of NaN is
    none and infinitely far."""
    starts, k, d = centres.shape
    flat = centres.reshape(starts * k, d)
    absent = np.isnan(flat).any(axis=1)
    flat = np.where(absent[:, None], 0.0, flat)
    apart = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ flat.T + (flat * flat).sum(axis=1)[None, :], 0.0)
    apart[:, absent] = np.inf
    return apart.reshape(len(x), starts, k)


def _uniform(rows: np.ndarray, start: int, draw: int, seed: int) -> np.ndarray:
    """A number in (0, 1) that depends on the row, the start and the draw alone, so that a task that runs
    again draws the same."""
    mixed = np.uint64((seed * 1_000_003 + start * 8_191 + draw) & 0xFFFFFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
    z = rows.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + mixed
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z = z ^ (z >> np.uint64(31))
    return (z.astype(np.float64) + 0.5) / 2.0**64


def _draws(x: np.ndarray, rows: np.ndarray, centres: np.ndarray | None, restarts: int, draw: int, seed: int) -> dict:
    """For every start the row with the smallest -log(u) / weight, a draw in proportion to the weights: the
    squared distances from the centres so far."""
    best = {}
    weights = np.ones((len(x), restarts)) if centres is None else _distances(x, centres).min(axis=2)
    for s in range(restarts):
        with np.errstate(divide="ignore", over="ignore"):
            race = -np.log(_uniform(rows, s, draw, seed)) / weights[:, s]
        i = int(np.argmin(race))
        if np.isfinite(race[i]):
            best[s] = (float(race[i]), x[i].tolist())
    return best


def _with_draw(centres: np.ndarray | None, chosen: dict, k: int, restarts: int, draw: int) -> np.ndarray:
    """A start that has no other row left to choose has fewer centres (NaN)."""
    if centres is None:
        centres = np.full((restarts, k, len(chosen[0])), np.nan)
    for s, v in chosen.items():
        centres[s, draw] = v
    return centres


def _seeds(data: DataFrame, k: int, restarts: int, seed: int) -> np.ndarray:
    """First centres of every start, one pass a centre."""
    centres = None
    for draw in range(k):

        def candidates(batches, draw=draw, centres=centres):
            best: dict[int, tuple[float, list]] = {}
            for b in batches:
                if b.num_rows:
                    for s, found in _draws(_matrix(b.column(0)), b.column(1).to_numpy(), centres, restarts, draw, seed).items():
                        best[s] = min(best.get(s, found), found)
            if best:
                races, vecs = zip(*best.values())
                columns = [pa.array(list(best), pa.int32()), pa.array(races), pa.array(vecs, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["start", "race", "vec"])

        found = data.mapInArrow(candidates, "start int, race double, vec array<double>")
        chosen = {r["start"]: r["vec"] for r in found.groupBy("start").agg(F.min_by("vec", "race").alias("vec")).collect()}
        centres = _with_draw(centres, chosen, k, restarts, draw)
    return centres


def _sums(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For every centre of every start: sum, number and squared distances of the rows nearest to it."""
    starts, k, d = centres.shape
    apart = _distances(x, centres)
    nearest = apart.argmin(axis=2) + np.arange(starts)[None, :] * k
    member = np.zeros((len(x), starts * k))
    member[np.arange(len(x))[:, None], nearest] = 1.0
    cost = (member * np.where(np.isfinite(apart), apart, 0.0).reshape(len(x), -1)).sum(axis=0)
    return np.column_stack([member.T @ x, member.sum(axis=0), cost]).reshape(starts, k, d + 2)


def _pass(data: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The sums over all rows: one aggregate whose size depends on the centres alone."""
    starts, k, d = centres.shape

    def add(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = _sums(_matrix(b.column(0)), centres).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total)], names=["i", "x"])

    total = np.zeros(starts * k * (d + 2))
    for r in data.mapInArrow(add, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        total[r["i"]] = r["x"]
    return total.reshape(starts, k, d + 2)


def _fit(sums, centres: np.ndarray, variance: float, max_iterations: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Centres, cost, iterations and whether it converged, for every start; ``sums`` makes a pass with some
    centres. Only starts that have not converged take part in a pass; a last one gives all costs."""
    steps, settled = np.zeros(len(centres), int), np.zeros(len(centres), bool)
    for _ in range(max_iterations):
        going = np.flatnonzero(~settled)
        if not len(going):
            break
        own = centres[going]
        total = sums(own)
        counts = total[:, :, -2]
        means = np.where(counts[:, :, None] > 0, total[:, :, :-2] / np.maximum(counts, 1)[:, :, None], own)
        moved = np.nansum((means - own) ** 2, axis=(1, 2))
        centres = centres.copy()
        centres[going] = means
        steps[going] += 1
        settled[going] = moved <= TOLERANCE * variance
    return centres, sums(centres)[:, :, -1].sum(axis=1), steps, settled


def _solve(data: DataFrame, k: int, restarts: int, seed: int, max_iterations: int):
    """Centres, costs, iterations and convergence of all starts."""
    spread = data.select(F.posexplode("vec").alias("d", "x")).groupBy("d").agg(F.var_pop("x").alias("v"))
    variance = spread.agg(F.avg("v")).first()[0] or 0.0
    return _fit(lambda centres: _pass(data, centres), _seeds(data, k, restarts, seed), variance, max_iterations)


def _solve_block(data: DataFrame, k: int, restarts: int, seed: int, max_iterations: int):
    """The same for rows of one block of bounded size: its task makes all passes by itself."""

    def run(batches):
        parts = [(_matrix(b.column(0)), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        x, rows = (np.concatenate(p) for p in zip(*parts))
        centres = None
        for draw in range(k):
            chosen = {s: v for s, (_, v) in _draws(x, rows, centres, restarts, draw, seed).items()}
            centres = _with_draw(centres, chosen, k, restarts, draw)
        found = _fit(lambda some: _sums(x, some), centres, float(x.var(axis=0).mean()), max_iterations)
        columns = [[v.ravel().tolist()] for v in found]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["centres", "costs", "steps", "settled"])

    schema = "centres array<double>, costs array<double>, steps array<long>, settled array<boolean>"
    r = data.mapInArrow(run, schema).first()
    return np.array(r["centres"]).reshape(restarts, k, -1), np.array(r["costs"]), np.array(r["steps"]), np.array(r["settled"])


def _nearest(vec: Column, centres: np.ndarray) -> Column:
    """Number of the nearest centre."""

    def apart(c: np.ndarray) -> Column:
        squares = F.zip_with(vec, F.array(*[F.lit(float(v)) for v in c]), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
        return F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)

    known = [c for c in centres if not np.isnan(c).any()]
    distances = F.array(*[apart(c) for c in known])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _numbered(labels: DataFrame, id: str) -> DataFrame:
    """Clusters numbered from 0 by their smallest id (there are ``k`` of them at most)."""
    first = labels.groupBy("cluster").agg(F.min(id).alias("_first"))
    number = (F.row_number().over(Window.orderBy("_first")) - 1).cast("int")
    return attach(labels, first.select("cluster", number.alias("_number")), ["cluster"]).select(
        *[F.col("_number").alias("cluster") if c == "cluster" else F.col(c) for c in labels.columns]
    )


# density clustering ----------------------------------------------------------------------------


def _spanning_edges(a: np.ndarray, b: np.ndarray, same: bool, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected sets between the ids of two tiles as stars: every member points to the smallest id."""
    rows_left = near.any(axis=1)
    u, v = [], []
    while rows_left.any():
        rows = np.zeros(len(a), dtype=bool)
        rows[np.flatnonzero(rows_left)[0]] = True
        columns = np.zeros(len(b), dtype=bool)
        while True:
            reached = near[rows].any(axis=0)
            grown = near[:, reached].any(axis=1) | rows
            if same:
                grown |= reached
            if (grown == rows).all() and (reached == columns).all():
                break
            rows, columns = grown, reached
        members = np.unique(np.concatenate([a[rows], b[columns]]))
        u.append(members[1:])
        v.append(np.full(len(members) - 1, members[0]))
        rows_left &= ~rows
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *u]), np.concatenate([none, *v])


def _may_touch(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Pairs of boxes whose centres are no farther apart than their radii and the root of ``limit``, with a little more
    for rounding."""
    d = a.shape[1] // 2
    centre_a, centre_b = (x[:, :d] + (x[:, d:] - x[:, :d]) / 2 for x in (a, b))
    radius_a, radius_b = (np.sqrt(((x[:, d:] - x[:, :d]) ** 2).sum(axis=1)).max(initial=0.0) / 2 for x in (a, b))
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    reach = (np.sqrt(limit) + radius_a + radius_b) * (1 + 1e-9) + 1e-12 * d * size
    return within(centre_a, centre_b, reach * reach) if np.isfinite(reach) else np.ones((len(a), len(b)), dtype=bool)


def _between_boxes(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of the nearest and of the farthest corners of pairs of boxes (lows, then highs). Rounding
    keeps order, so no two points of the boxes have a computed distance outside these."""
    least, most = np.zeros(len(p)), np.zeros(len(p))
    d = a.shape[1] // 2
    for i in range(d):
        up, down = a[p, i + d] - b[q, i], b[q, i + d] - a[p, i]
        least += np.maximum(np.maximum(-up, -down), 0) ** 2
        most += np.maximum(up, down) ** 2
    return least, most


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id of each connected group. Every round takes the smallest label
    among neighbours and then follows labels one step, so long chains shrink fast; rounds are
    checkpointed."""
    both = checkpointed(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = checkpointed(nodes.select("id", F.col("id").alias("label")))
    while True:
        heard = both.join(labels, both["v"] == labels["id"]).groupBy("u").agg(F.min("label").alias("_heard"))
        lower = labels.join(heard, labels["id"] == heard["u"], "left").select(
            "id", F.col("label").alias("_old"), F.least("label", F.coalesce("_heard", "label")).alias("label")
        )
        jump = lower.select(F.col("id").alias("label"), F.col("label").alias("_root"))
        new = checkpointed(
            lower.join(jump, "label", "left").select("id", "_old", F.least("label", "_root").alias("label"))
        )
        changed = not new.filter(F.col("label") != F.col("_old")).isEmpty()
        labels = new.select("id", "label")
        if not changed:
            return labels


def dbscan(
    points: DataFrame, id: str, vec: str = "vec", eps: float = 0.5, min_samples: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Density clusters. Returns the rows with ``cluster`` (-1 is noise; clusters are numbered by
    their smallest core id) and a one-row report.

    Exact copies of a vector collapse to one weighted point. Points are put into cells of width ``eps`` on the
    three dimensions that vary most; only tiles of touching cells are compared, and every comparison is exact in
    all dimensions. All points of a small cell (``eps`` over the root of the dimensions) are neighbours: with
    ``min_samples`` rows in it they are core without a comparison, and its core points are one node of the
    links. So only points of thinly filled small cells are compared one by one, and a dense place costs in
    proportion to its points. In crowded cells tiles first meet a few others: points that have their neighbours then
    are core whatever else is near, and only the others meet all. Links between small cells are decided by the corners of boxes of their core
    points; the points themselves are compared only for boxes that the corners leave open, and only while
    nothing else connects the two cells; in crowded cells a few tiles are linked first, and what hangs together
    by then is not compared again. Rows need a vector without nulls.
    """
    data = points.select(F.col(id).alias("id"), F.transform(vec, lambda x: x.cast("double")).alias("vec"))
    total = data.count()
    need = min_samples if total >= min_samples else max(1, total // 2)
    merged = data.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    merged, varying, length = _with_cells(merged, eps)
    cells = [c for c in merged.columns if c.startswith("c_")]
    limit = eps * eps
    width = eps / np.ceil(np.sqrt(max(1, len(varying))))
    lows = F.array(*[F.min(F.col("vec")[i]) for i in range(length)]).cast("array<double>")
    highs = F.array(*[F.max(F.col("vec")[i]) for i in range(length)]).cast("array<double>")

    small = [*cells, "_small"]
    merged = merged.withColumn("_small", F.array(*[F.floor(F.col("vec")[i] / F.lit(width)) for i in varying]).cast("array<long>"))
    filled = merged.groupBy(*small).agg(F.sum("weight").alias("_rows"), lows.alias("_low"), highs.alias("_high"))
    across = F.aggregate(F.zip_with("_high", "_low", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    filled = filled.select(*small, "_rows", (across <= limit).alias("_tight"))
    merged = checkpointed(attach(merged, filled, small).withColumn("sure", F.col("_tight") & (F.col("_rows") >= need)))

    def count_both(a, b, same):
        near = within(a.vec, b.vec, limit)
        to_a = near @ b.weight
        if same:
            return {"id": a.id, "n": to_a}
        return {"id": np.concatenate([a.id, b.id]), "n": np.concatenate([to_a, a.weight @ near])}

    def count_near(a, b, same):
        return {"id": a.id, "n": within(a.vec, b.vec, limit) @ b.weight}

    if _crowded(merged, cells):
        probe = compare_tiles(merged.filter("not sure"), count_near, "id long, n long", ["weight"], cells, against=merged, few=1)
        found = probe.groupBy("id").agg(F.sum("n").alias("_n")).filter(F.col("_n") >= need)
        merged = attach(merged, found, ["id"]).withColumn("sure", F.col("sure") | F.col("_n").isNotNull()).drop("_n")
        merged = checkpointed(merged)
    loose = merged.filter("not sure")
    counts = compare_tiles(loose, count_both, "id long, n long", ["weight"], cells, once=True).unionByName(
        compare_tiles(loose, count_near, "id long, n long", ["weight"], cells, against=merged.filter("sure"))
    )
    counts = counts.groupBy("id").agg(F.sum("n").alias("_n"))
    merged = attach(merged, counts, ["id"]).withColumn("core", F.col("sure") | (F.col("_n") >= need))
    merged = checkpointed(merged.withColumn("core", F.coalesce("core", F.lit(False))).drop("_n", "_rows", "sure"))
    roots = _linked(merged.filter("core"), cells, limit, width, lows, highs)
    order = Series.of(roots.select("label").distinct(), [], ["label"]).position("number").done()
    numbered = attach(merged, roots.join(order, "label").select("id", "number"), ["id"])
    numbered = checkpointed(numbered.withColumn("number", F.coalesce("number", F.lit(-1))))

    def adopt(a, b, same):
        far = np.iinfo(np.int64).max
        near = within(a.vec, b.vec, limit)
        best = np.where(near, b.number[None, :], far).min(axis=1)
        return {"id": a.id[best < far], "border": best[best < far]}

    outside, inside = numbered.filter("not core"), numbered.filter("core")
    border = compare_tiles(outside, adopt, "id long, border long", ["number"], cells, against=inside)
    border = border.groupBy("id").agg(F.min("border").alias("border"))
    final = attach(numbered, border, ["id"])
    final = final.select("vec", F.when(F.col("core"), F.col("number")).otherwise(F.coalesce("border", F.lit(-1))).alias("cluster"))
    labels = data.join(final, "vec").select(F.col("id").alias(id), F.col("cluster").cast("int").alias("cluster"))
    labelled = attach(points, labels, [id])
    noise = F.count_if(F.col("cluster") == -1)
    report = labels.agg(
        F.lit(eps).alias("eps"),
        F.lit(min_samples).alias("min_samples"),
        F.lit(need).alias("actual_min_samples"),
        (F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster")))).alias("n_clusters"),
        F.count_distinct("cluster").alias("n_labels"),
        noise.alias("n_noise_points"),
        (100 * share(noise, F.count("*"))).alias("noise_percentage"),
    )
    return labelled, report


def _crowded(points: DataFrame, cells: list[str]) -> bool:
    """Whether the cells hold more than ``CROWDED`` points on average."""
    rows = points.groupBy(*cells).count().agg(F.avg("count")).first()[0]
    return (rows or 0) > CROWDED


def _linked(core: DataFrame, cells: list[str], limit: float, width: float, lows: Column, highs: Column) -> DataFrame:
    """(id, label) of the core points: the smallest core id of the cluster."""
    node = [*cells, "_small", "_alone"]
    core = core.withColumn("_alone", F.when(~F.col("_tight"), F.col("id")))  # a small cell that is not one
    nodes = core.groupBy(*node).agg(F.min("id").alias("node"), F.count("*").alias("_points"))
    core = attach(core, nodes, node)
    many = F.col("_points") > FEW
    part = F.array(*[F.floor(F.col("vec")[int(c[2:])] / F.lit(width / PARTS)) for c in cells]).cast("array<long>")
    core = core.withColumns({"_part": F.when(many, part), "_own": F.when(~many, F.col("id"))})
    key = ["node", *cells, "_part", "_own"]
    boxes = checkpointed(core.groupBy(*key).agg(F.min("id").alias("id"), F.concat(lows, highs).alias("vec")))
    core = checkpointed(attach(core, boxes.withColumnRenamed("id", "box").drop("vec"), key).select("id", "vec", "node", "box"))

    def corners(a, b, same):
        i, j = np.nonzero(_may_touch(a.vec, b.vec, limit))
        least, most = _between_boxes(a.vec, b.vec, i, j)
        near = a.node[:, None] == b.node[None, :]
        near[i[most <= limit], j[most <= limit]] = True
        u, v = _spanning_edges(a.node, b.node, same, near)
        root = dict(zip(u.tolist(), v.tolist()))
        of_a, of_b = (np.array([root.get(n, n) for n in t.node.tolist()]) for t in (a, b))
        open_ = (least <= limit) & (most > limit) & (of_a[i] != of_b[j])
        i, j = i[open_], j[open_]
        return {
            "u": np.concatenate([u, a.id[i]]),
            "v": np.concatenate([v, b.id[j]]),
            "certain": np.arange(len(u) + len(i)) < len(u),
        }

    ids = core.select(F.col("node").alias("id")).distinct()
    schema = "u long, v long, certain boolean"
    if _crowded(boxes, cells):
        first = checkpointed(compare_tiles(boxes, corners, schema, ["node"], cells, few=2).filter("certain").select("u", "v"))
        known = components(ids, first).withColumnsRenamed({"id": "node", "label": "_label"})
        large = known.groupBy("_label").agg(F.count("*").alias("_many")).filter(F.col("_many") >= TILE)
        known = attach(known, large, ["_label"]).select("node", F.when(F.col("_many").isNotNull(), F.col("_label")).alias("_label"))
        labelled = checkpointed(attach(boxes, known, ["node"]))
        found = compare_tiles(labelled, corners, schema, ["node"], cells, once=True, apart="_label")
        found = checkpointed(found.unionByName(first.withColumn("certain", F.lit(True))))
    else:
        found = checkpointed(compare_tiles(boxes, corners, schema, ["node"], cells, once=True))
    certain = found.filter("certain").select("u", "v")
    roots = components(ids, certain)
    held = boxes.select("id", F.col("node").alias("_n")).join(roots.select(F.col("id").alias("_n"), "label"), "_n")
    open_ = (
        found.filter("not certain")
        .join(held.select(F.col("id").alias("u"), F.col("label").alias("_u")), "u")
        .join(held.select(F.col("id").alias("v"), F.col("label").alias("_v")), "v")
        .filter("_u <> _v")
        .select(F.struct(F.col("u").alias("box")).alias("a_cell"), F.struct(F.col("v").alias("box")).alias("b_cell"))
        .distinct()
    )
    open_ = checkpointed(open_)
    if not open_.isEmpty():

        def touch(a, b, same):
            if within(a.vec, b.vec, limit).any():
                return {"u": a.node[:1], "v": b.node[:1]}

        more = compare_tiles(core, touch, "u long, v long", ["node"], ["box"], near=open_)
        roots = components(ids, certain.unionByName(more))
    return core.select("id", F.col("node").alias("_n")).join(roots.select(F.col("id").alias("_n"), "label"), "_n").drop("_n")


def _with_cells(points: DataFrame, eps: float, most: int = 3) -> tuple[DataFrame, list[int], int]:
    """Cell numbers on the dimensions with the largest variance; the dimensions that vary and the length of the
    vectors (one row per dimension on the driver)."""
    spread = points.select(F.posexplode("vec").alias("d", "x")).groupBy("d").agg(F.var_pop("x").alias("s"))
    rows = sorted(spread.collect(), key=lambda r: (-(r["s"] or 0), r["d"]))
    varying = [r["d"] for r in rows if (r["s"] or 0) > 0]
    chosen = {f"c_{d}": F.floor(F.col("vec")[d] / F.lit(eps)) for d in varying[:most]}
    return points.withColumns(chosen) if chosen else points, sorted(varying), len(rows)


# quality ---------------------------------------------------------------------------------------


def _indicators(label: np.ndarray):
    """The labels of a tile, and for a block of its points the columns of those present and which point has which."""
    labels, inverse = np.unique(label, return_inverse=True)

    def block(rows: slice) -> tuple[np.ndarray, np.ndarray]:
        present, own = np.unique(inverse[rows], return_inverse=True)
        indicator = np.zeros((len(own), len(present)))
        indicator[np.arange(len(own)), own] = 1.0
        return present, indicator

    return labels, block


def silhouette(points: DataFrame, id: str = "id", vec: str = "vec", label: str = "cluster") -> DataFrame:
    """Mean silhouette with Euclidean distances, exact: every unordered pair of tiles is compared once and
    returns the summed distance of each point of either tile to each cluster of the other. Tiles grow with the rows,
    as the points that travel and the sums that return are in proportion to the pairs of tiles; they are compared
    block by block, and their sums are combined in the task before they are exchanged. The work grows with the square of the rows; for very large sets
    ``silhouette_squared`` is the linear measure. Null unless 2 <= labels < rows."""
    data = points.select(F.col(id).alias("id"), F.col(vec).alias("vec"), F.col(label).cast("long").alias("label"))
    sizes = data.groupBy("label").agg(F.count("*").alias("_size"))
    schema = "id long, own long, label long, total double"

    def flat(a, labels, sums):
        return np.repeat(a.id, len(labels)), np.repeat(a.label, len(labels)), np.tile(labels, len(a.id)), sums.ravel()

    def sums(a, b, same):
        (labels_a, one_a), (labels_b, one_b) = (_indicators(t.label) for t in (a, b))
        of_a, of_b = np.zeros((len(a.id), len(labels_b))), np.zeros((len(b.id), len(labels_a)))
        for i in range(0, len(a.id), BLOCK):
            for j in range(0, len(b.id), 2 * BLOCK):
                p, q = slice(i, i + BLOCK), slice(j, j + 2 * BLOCK)
                apart = distances(a.vec[p], b.vec[q])
                present, indicator = one_b(q)
                of_a[p, present] += apart @ indicator
                if not same:
                    present, indicator = one_a(p)
                    of_b[q, present] += apart.T @ indicator
        found = [flat(a, labels_b, of_a)] if same else [flat(a, labels_b, of_a), flat(b, labels_a, of_b)]
        return dict(zip(("id", "own", "label", "total"), map(np.concatenate, zip(*found))))

    facts = sizes.agg(F.sum("_size"), F.count("*")).first()
    tile = int(np.clip((facts[0] or 0) // 48, TILE, max(TILE, min(LARGE_TILE, MOST_SUMS // max(1, facts[1])))))
    totals = compare_tiles(data, sums, schema, ["label"], once=True, tile=tile)
    totals = totals.groupBy("id", "own", "label").agg(F.sum("total").alias("_total"))
    means = attach(totals, sizes, ["label"])
    mine = F.col("label") == F.col("own")
    per_point = means.groupBy("id").agg(
        F.max(F.when(mine, F.col("_size"))).alias("_own"),
        F.max(F.when(mine, F.try_divide(F.col("_total"), F.col("_size") - 1))).alias("_a"),
        F.min(F.when(~mine, F.col("_total") / F.col("_size"))).alias("_b"),
        F.count("*").alias("_labels"),
    )
    a, b = F.col("_a"), F.col("_b")
    s = F.when(F.col("_own") == 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    result = per_point.agg(F.avg(s).alias("_s"), F.count("*").alias("_n"), F.max("_labels").alias("_k"))
    valid = (F.col("_k") >= 2) & (F.col("_k") < F.col("_n"))
    return result.select(F.when(valid, F.col("_s")).alias("silhouette_score"))


def _dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _apart(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def centroids(points: DataFrame, vec: str = "vec", label: str = "cluster") -> DataFrame:
    """(label, vec): mean vector per cluster, averaged per dimension with partial sums."""
    cells = points.select(label, F.posexplode(F.transform(vec, lambda x: x.cast("double"))).alias("_d", "_x"))
    means = cells.groupBy(label, "_d").agg(F.avg("_x").alias("_x"))
    ordered = F.array_sort(F.collect_list(F.struct("_d", "_x")))
    return means.groupBy(label).agg(F.transform(ordered, lambda p: p["_x"]).alias("_centre"))


def cluster_table(points: DataFrame, vec: str = "vec", label: str = "cluster") -> DataFrame:
    """One row per cluster: label, centre, n, square (mean squared length of its vectors), spread (mean
    distance from the centre), and the block of ``CENTRES`` clusters that it belongs to."""
    data = points.select(F.col(label).cast("long").alias("label"), F.transform(vec, lambda x: x.cast("double")).alias("vec"))
    facts = attach(data, centroids(data, "vec", "label"), ["label"]).groupBy("label").agg(
        F.first("_centre").alias("centre"),
        F.count("*").alias("n"),
        F.avg(_dot("vec", "vec")).alias("square"),
        F.avg(F.sqrt(_apart("vec", "_centre"))).alias("spread"),
    )
    numbered = Series.of(facts, [], ["label"]).position("_no").done()
    return checkpointed(numbered.withColumn("block", F.floor(F.col("_no") / CENTRES).cast("int")).drop("_no"))


def _beside_blocks(rows: DataFrame, table: DataFrame) -> tuple[DataFrame, int]:
    """Every row beside every block of clusters, a bounded number of them at a time as ``others``; and the
    number of blocks."""
    blocks = (table.agg(F.max("block")).first()[0] or 0) + 1
    packed = table.groupBy("block").agg(F.collect_list(F.struct("label", "centre", "n", "square", "spread")).alias("others"))
    return rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, "block"), blocks


def _several(table: DataFrame) -> DataFrame:
    """Whether 2 <= labels < rows."""
    return table.agg(((F.count("*") >= 2) & (F.count("*") < F.sum("n"))).alias("_valid"))


def silhouette_squared(points: DataFrame, vec: str = "vec", label: str = "cluster", table: DataFrame | None = None) -> DataFrame:
    """Mean silhouette with squared Euclidean distances: the mean squared distance of x to a cluster is
    |x|^2 - 2 x.m + (mean of |y|^2), with m the cluster's mean. A row meets its own cluster in a join and all
    clusters block by block, of which only the least distance is kept. Null unless 2 <= labels < rows.
    ``table`` is the clusters' ``cluster_table``."""
    table = cluster_table(points, vec, label) if table is None else table
    data = points.select(
        F.col(label).cast("long").alias("label"),
        F.transform(vec, lambda x: x.cast("double")).alias("vec"),
        F.monotonically_increasing_id().alias("row"),
    )
    own = table.select("label", F.col("centre").alias("_centre"), F.col("n").alias("_n"), F.col("square").alias("_square"))
    rows = attach(data, own, ["label"]).withColumn("_length", _dot("vec", "vec"))

    def mean_apart(centre, square) -> Column:
        return F.greatest(F.col("_length") - 2 * _dot(F.col("vec"), centre) + square, F.lit(0.0))

    a = F.try_divide(mean_apart(F.col("_centre"), F.col("_square")) * F.col("_n"), F.col("_n") - 1)
    beside, blocks = _beside_blocks(rows.withColumn("_a", a).drop("_centre", "_square"), table)
    near = F.array_min(F.transform(F.filter("others", lambda c: c["label"] != F.col("label")), lambda c: mean_apart(c["centre"], c["square"])))
    per_row = beside.select("row", "_n", "_a", near.alias("_b"))
    if blocks > 1:
        per_row = per_row.groupBy("row").agg(F.first("_n").alias("_n"), F.first("_a").alias("_a"), F.min("_b").alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    s = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return attach(per_row.agg(F.avg(s).alias("_s")), _several(table), []).select(F.when(F.col("_valid"), F.col("_s")).alias("silhouette_score"))


def davies_bouldin(points: DataFrame, vec: str = "vec", label: str = "cluster", table: DataFrame | None = None) -> DataFrame:
    """Mean over clusters of the worst (spread_i + spread_j) / distance_ij; clusters with one centre have no
    ratio. Null unless 2 <= labels < rows."""
    table = cluster_table(points, vec, label) if table is None else table
    beside, blocks = _beside_blocks(table.select(F.col("label").alias("own"), F.col("centre").alias("_centre"), F.col("spread").alias("_spread")), table)

    def ratio(c) -> Column:
        distance = F.sqrt(_apart(F.col("_centre"), c["centre"]))
        return F.when(distance > 0, (F.col("_spread") + c["spread"]) / distance).otherwise(F.lit(0.0))

    others = F.filter("others", lambda c: c["label"] != F.col("own"))
    worst = beside.select("own", F.coalesce(F.array_max(F.transform(others, ratio)), F.lit(0.0)).alias("_w"))
    if blocks > 1:
        worst = worst.groupBy("own").agg(F.max("_w").alias("_w"))
    return attach(worst.agg(F.avg("_w").alias("_score")), _several(table), []).select(
        F.when(F.col("_valid"), F.col("_score")).alias("davies_bouldin_score")
    )


def cluster_statistics(labelled: DataFrame, label: str = "cluster", by: list[str] = ()) -> DataFrame:
    by = list(by)
    sizes = labelled.groupBy(*by, label).agg(F.count("*").alias("size"))
    total = sizes.groupBy(*by).agg(F.sum("size").alias("_total"))
    rows = attach(sizes, total, by).withColumn("percentage", F.bround(100 * share(F.col("size"), F.col("_total")), 2))
    return rows.drop("_total").orderBy(*by, F.desc("size"), label)


def pca(points: DataFrame, vec: str = "vec", components: int = 2) -> tuple[DataFrame, DataFrame]:
    """Rows with ``pc1``, ``pc2`` … of the centred vectors, and the explained-variance ratios. The
    sign of a component makes its largest loading positive."""
    means = points.select(F.posexplode(vec).alias("_d", "_x")).groupBy("_d").agg(F.avg("_x").alias("_m"))
    means = means.agg(F.transform(F.array_sort(F.collect_list(F.struct("_d", "_m"))), lambda p: p["_m"]).alias("_mean"))
    centred = attach(points, means, []).withColumn("_c", array_to_vector(F.zip_with(vec, "_mean", lambda x, m: x - m)))
    model = PCA(k=components, inputCol="_c", outputCol="_p").fit(centred)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), range(components)])
    projected = model.transform(centred).withColumn("_p", vector_to_array("_p"))
    rows = projected.withColumns({f"pc{i + 1}": F.col("_p")[i] * F.lit(float(s)) for i, s in enumerate(signs)})
    ratios = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    report = points.sparkSession.createDataFrame(ratios, "component int, explained_variance_ratio double")
    return rows.drop("_c", "_p", "_mean"), report


def cluster_features(
    matrix: DataFrame,
    id: str,
    columns: list[str],
    data_type: str,
    method: str = "kmeans",
    k: int = 3,
    eps: float = 0.5,
    min_samples: int = 5,
    exact_silhouette: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Standardise, cluster, measure. Returns the matrix rows with ``cluster`` and a one-row report;
    the sizes of the clusters are ``cluster_statistics``.

    The silhouette uses squared distances, which is linear in the rows; ``exact_silhouette`` takes plain
    distances between all pairs. Fewer than two rows are not clustered: no rows come back, and the
    report has ``success`` false and says why.
    """
    if method not in ("kmeans", "dbscan"):
        raise ValueError(f"unknown clustering method {method}")
    scaled = with_vector(standardize(matrix, columns), columns).select(id, "vec")
    scaled = checkpointed(scaled)
    rows = scaled.count()
    if rows < 2:
        failed = matrix.sparkSession.createDataFrame(
            [(rows, data_type, method, len(columns), False, TOO_FEW_ROWS % rows)],
            "n_samples long, data_type string, method string, n_features int, success boolean, error string",
        )
        return matrix.withColumn("cluster", F.lit(None).cast("int")).filter("1 = 0"), failed
    if method == "kmeans":
        labels, model = kmeans(scaled, k, id=id)
    else:
        labels, model = dbscan(scaled, id, "vec", eps, min_samples)
    labels = checkpointed(labels.select(id, "vec", "cluster"))
    sizes = labels.groupBy("cluster").agg(F.count("*").alias("_n"))
    report = sizes.agg(
        F.sum("_n").alias("n_samples"),
        F.count("*").alias("n_labels"),
    )
    report = report.withColumns(
        {"data_type": F.lit(data_type), "method": F.lit(method), "n_features": F.lit(len(columns))}
    )
    report = attach(report, model.drop("n_labels"), [])
    table = cluster_table(labels)
    report = attach(report, silhouette(labels, id) if exact_silhouette else silhouette_squared(labels, table=table), [])
    report = attach(report, davies_bouldin(labels, table=table), [])
    report = report.withColumns({"success": F.lit(True), "error": F.lit(None).cast("string")})
    return attach(matrix, labels.select(id, "cluster"), [id]), report
