"""Clustering and its measures, on the embedding vectors and on numeric columns."""

from pyspark.sql import functions as F

from vitalgrid.operators import cluster
from vitalgrid.queries.registry import R, query

EPS, MIN_SAMPLES = 1.2, 5
VECTORS = "SELECT vec_id AS id, embedding::double[] AS vec, label FROM embeddings"


def points(t):
    vec = F.transform("embedding", lambda x: x.cast("double"))
    return t.embeddings.select(F.col("vec_id").alias("id"), vec.alias("vec"), F.col("label").alias("cluster"))


@query(
    "c1_standardize",
    f"""
    WITH s AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mp, stddev_pop(p_retailprice) AS sp FROM part)
    SELECT p_partkey, {R('(p_size - ms) / ss')} AS p_size, {R('(p_retailprice - mp) / sp')} AS p_retailprice, {R('0')} AS one FROM part, s
    """,
)
def _(t):
    df = t.part.select("p_partkey", F.col("p_size").cast("double"), "p_retailprice", F.lit(1.0).alias("one"))
    return cluster.standardize(df, ["p_size", "p_retailprice", "one"])


# three groups far apart: whatever the start, K-means has to find them
PLANTED = """
    p AS (SELECT vec_id AS id, label % 3 AS part, list_transform(embedding::double[], lambda x: x + 100 * (label % 3)) AS vec FROM embeddings),
    numbered AS (SELECT part, row_number() OVER (ORDER BY min(id)) - 1 AS cluster FROM p GROUP BY part)
"""


def planted(t):
    vec = F.expr("transform(embedding, x -> cast(x as double) + 100 * (label % 3))")
    return t.embeddings.select(F.col("vec_id").alias("id"), vec.alias("vec"))


@query("c2_kmeans", f"WITH {PLANTED} SELECT id, cluster::bigint AS cluster FROM p JOIN numbered USING (part)")
def _(t):
    labels, _report = cluster.kmeans(planted(t), 3, id="id")
    return labels.select("id", "cluster")


@query(
    "c2_kmeans_report",
    f"""
    WITH {PLANTED},
    cells AS (SELECT id, part, generate_subscripts(vec, 1) AS d, unnest(vec) AS x FROM p),
    mean AS (SELECT part, d, avg(x) AS m FROM cells GROUP BY part, d)
    SELECT round(sum((x - m) * (x - m)), 4) AS inertia, true AS converged, 3::bigint AS requested_clusters, 3::bigint AS actual_clusters
    FROM cells JOIN mean USING (part, d)
    """,
)
def _(t):
    _labels, report = cluster.kmeans(planted(t), 3, id="id")
    return report.select(F.round("inertia", 4).alias("inertia"), "converged", "requested_clusters", "actual_clusters")


@query(
    "c3_dbscan",
    f"""
    WITH RECURSIVE v AS ({VECTORS}),
    near AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON list_distance(a.vec, b.vec) <= {EPS}::double),
    core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
    links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach(id, root) AS (SELECT id, id FROM core UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id),
    roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
    numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM roots),
    border AS (SELECT near.a AS id, min(cluster) AS cluster FROM near JOIN numbered ON numbered.id = near.b
               WHERE near.a NOT IN (SELECT id FROM core) GROUP BY near.a)
    SELECT v.id, coalesce(numbered.cluster, border.cluster, -1)::bigint AS cluster
    FROM v LEFT JOIN numbered USING (id) LEFT JOIN border USING (id)
    """,
)
def _(t):
    labels, _report = cluster.dbscan(points(t).drop("cluster"), "id", "vec", EPS, MIN_SAMPLES)
    return labels.select("id", "cluster")


@query(
    "c4_silhouette",
    f"""
    WITH v AS ({VECTORS}), sizes AS (SELECT label, count(*) AS n FROM v GROUP BY label),
    d AS (SELECT a.id, a.label AS own, b.label, sum(list_distance(a.vec, b.vec)) AS total FROM v a, v b GROUP BY ALL),
    m AS (SELECT id, own, label, CASE WHEN label = own THEN total / nullif(n - 1, 0) ELSE total / n END AS mean, n FROM d JOIN sizes USING (label)),
    p AS (SELECT id, max(n) FILTER (label = own) AS n, max(mean) FILTER (label = own) AS a, min(mean) FILTER (label <> own) AS b FROM m GROUP BY id)
    SELECT {R('avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette_score FROM p
    """,
)
def _(t):
    return cluster.silhouette(points(t))


CENTRES = f"""
    v AS ({VECTORS}),
    cells AS (SELECT id, label, generate_subscripts(vec, 1) AS d, unnest(vec) AS x FROM v),
    mean AS (SELECT label, d, avg(x) AS m FROM cells GROUP BY label, d),
    centre AS (SELECT label, list(m ORDER BY d) AS c FROM mean GROUP BY label)
"""


@query(
    "c5_davies_bouldin",
    f"""
    WITH {CENTRES},
    spread AS (SELECT label, avg(list_distance(vec, c)) AS s FROM v JOIN centre USING (label) GROUP BY label),
    r AS (SELECT a.label, max((x.s + y.s) / list_distance(a.c, b.c)) AS worst
          FROM centre a JOIN centre b ON a.label <> b.label JOIN spread x ON x.label = a.label JOIN spread y ON y.label = b.label GROUP BY a.label)
    SELECT {R('avg(worst)')} AS davies_bouldin_score FROM r
    """,
)
def _(t):
    return cluster.davies_bouldin(points(t))


# one row a user, in three groups far apart
USERS = """
    u AS (SELECT user_id, avg(value) + 10000 * (user_id % 3) AS a, max(value) - 7000 * (user_id % 3) AS b, user_id % 3 AS part
          FROM events GROUP BY user_id),
    s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM u),
    z AS (SELECT user_id AS id, part, [(a - ma) / sa, (b - mb) / sb] AS v FROM u, s),
    centre AS (SELECT part, [avg(v[1]), avg(v[2])] AS c, count(*) AS n FROM z GROUP BY part),
    apart AS (SELECT z.id, z.part, y.part AS other, avg(list_distance(z.v, y.v) ** 2) AS d, count(*) AS n FROM z JOIN z y ON true GROUP BY ALL),
    sil AS (SELECT id, max(d * n / (n - 1)) FILTER (part = other) AS own, min(d) FILTER (part <> other) AS near FROM apart GROUP BY id),
    spread AS (SELECT part, c, avg(list_distance(v, c)) AS w FROM z JOIN centre USING (part) GROUP BY part, c),
    worst AS (SELECT x.part, max((x.w + y.w) / list_distance(x.c, y.c)) AS r FROM spread x JOIN spread y ON x.part <> y.part GROUP BY x.part)
"""


def users(t):
    part = F.col("user_id") % 3
    return t.events.groupBy("user_id").agg(F.avg("value").alias("a"), F.max("value").alias("b")).select(
        "user_id", (F.col("a") + 10000 * part).alias("a"), (F.col("b") - 7000 * part).alias("b")
    )


MEASURES = f"""
    {R('(SELECT avg((near - own) / greatest(near, own)) FROM sil)')} AS silhouette_score,
    {R('(SELECT avg(r) FROM worst)')} AS davies_bouldin_score
"""


@query(
    "c6_cluster_report",
    f"""
    WITH {USERS}
    SELECT (SELECT count(*) FROM z)::bigint AS n_samples, 3::bigint AS n_labels, 'heart_rate' AS data_type, 'kmeans' AS method, 2::bigint AS n_features,
        {R('(SELECT sum(list_distance(v, c) ** 2) FROM z JOIN centre USING (part))')} AS inertia, true AS converged,
        3::bigint AS requested_clusters, 3::bigint AS actual_clusters, {MEASURES}, true AS success, NULL AS error
    """,
)
def _(t):
    _rows, report = cluster.cluster_features(users(t), "user_id", ["a", "b"], "heart_rate", k=3)
    return report.drop("n_iterations")


@query(
    "c6_cluster_rows",
    f"""
    WITH {USERS}, numbered AS (SELECT part, row_number() OVER (ORDER BY min(id)) - 1 AS cluster FROM z GROUP BY part)
    SELECT id AS user_id, cluster::bigint AS cluster FROM z JOIN numbered USING (part)
    """,
)
def _(t):
    rows, _report = cluster.cluster_features(users(t), "user_id", ["a", "b"], "heart_rate", k=3)
    return rows.select("user_id", "cluster")


@query(
    "c6_dbscan_report",
    f"""
    WITH {USERS}
    SELECT (SELECT count(*) FROM z)::bigint AS n_samples, 3::bigint AS n_labels, 'heart_rate' AS data_type, 'dbscan' AS method, 2::bigint AS n_features,
        {R('0.5')} AS eps, 5::bigint AS min_samples, 5::bigint AS actual_min_samples, 3::bigint AS n_clusters, 0::bigint AS n_noise_points,
        {R('0')} AS noise_percentage, {MEASURES}, true AS success, NULL AS error
    """,
)
def _(t):
    _rows, report = cluster.cluster_features(users(t), "user_id", ["a", "b"], "heart_rate", "dbscan")
    return report


@query(
    "c6_too_few_rows",
    "SELECT 1::bigint AS n_samples, 'sleep' AS data_type, 'kmeans' AS method, 2::bigint AS n_features, false AS success,"
    " 'Insufficient data: only 1 sample(s) available for clustering. Need at least 2 samples.' AS error",
)
def _(t):
    one = users(t).agg(F.min("user_id").alias("user_id"), F.avg("a").alias("a"), F.max("b").alias("b"))
    _rows, report = cluster.cluster_features(one, "user_id", ["a", "b"], "sleep")
    return report


@query(
    "c7_pca_variance",
    f"""
    WITH n AS (SELECT count(*) AS n, var_samp(p_size) AS a, var_samp(p_retailprice / 100) AS b, covar_samp(p_size, p_retailprice / 100) AS c FROM part),
    e AS (SELECT (a + b + sqrt((a - b) * (a - b) + 4 * c * c)) / 2 AS l1, (a + b - sqrt((a - b) * (a - b) + 4 * c * c)) / 2 AS l2 FROM n)
    SELECT 1::bigint AS component, {R('l1 / (l1 + l2)')} AS explained_variance_ratio FROM e
    UNION ALL SELECT 2, {R('l2 / (l1 + l2)')} FROM e
    """,
)
def _(t):
    df = t.part.select("p_partkey", F.array(F.col("p_size").cast("double"), F.col("p_retailprice") / 100).alias("vec"))
    _rows, report = cluster.pca(df)
    return report


@query(
    "c7_pca_projection",
    f"""
    WITH v AS (SELECT p_partkey, p_size::double AS x, p_retailprice / 100 AS y FROM part),
    m AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c FROM v),
    e AS (SELECT *, atan2(2 * c, a - b) / 2 AS angle FROM m),
    d AS (SELECT *, cos(angle) AS co, sin(angle) AS si FROM e),
    s AS (SELECT *, sign(CASE WHEN abs(co) >= abs(si) THEN co ELSE si END) AS s1, sign(CASE WHEN abs(si) >= abs(co) THEN -si ELSE co END) AS s2 FROM d)
    SELECT p_partkey, {R('s1 * (co * (x - mx) + si * (y - my))')} AS pc1, {R('s2 * (co * (y - my) - si * (x - mx))')} AS pc2 FROM v, s
    """,
)
def _(t):
    df = t.part.select("p_partkey", F.array(F.col("p_size").cast("double"), F.col("p_retailprice") / 100).alias("vec"))
    rows, _report = cluster.pca(df)
    return rows.select("p_partkey", "pc1", "pc2")


@query(
    "c8_cluster_statistics",
    f"SELECT label::bigint AS cluster, count(*) AS size, {R('round_even((100::double * count(*) / (SELECT count(*) FROM embeddings))::decimal(28, 10), 2)')} AS percentage FROM embeddings GROUP BY label",
)
def _(t):
    return cluster.cluster_statistics(points(t))
