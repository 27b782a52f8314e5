"""Operators against brute force on small data."""

import datetime as dt
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalgrid.functions import stats
from vitalgrid.operators import align, anomaly, clean, cluster, columns, describe, features, forecast, missing, quality, zones
from vitalgrid.plans import stages
from vitalgrid.plans.series import attach


def test_p_value():
    assert stats.slope_p_value([0.0], [10])[0] == pytest.approx(1.0)
    for t, dof in ((2.228139, 10), (12.7062, 1), (1.959964, 1e6)):
        r = t / math.sqrt(t * t + dof)
        assert stats.slope_p_value([r], [dof + 2])[0] == pytest.approx(0.05, abs=1e-6)
    assert stats.slope_p_value([1.0], [2])[0] == 0.0


def brute_entropy(x, m=2, r=0.2):
    r = r * np.std(x)

    def phi(m):
        parts = np.array([x[i : i + m] for i in range(len(x) - m + 1)])
        c = [(np.abs(parts - p).max(axis=1) <= r).mean() for p in parts]
        return np.log(c).mean()

    return abs(phi(m) - phi(m + 1))


def test_approximate_entropy():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(4, 30))
    assert stats.approximate_entropy(rows) == pytest.approx([brute_entropy(x) for x in rows])
    assert stats.approximate_entropy(np.zeros((1, 3)))[0] == 0


def test_trend_matches_numpy(spark):
    rng = np.random.default_rng(1)
    y = np.arange(40) * 0.3 + rng.normal(size=40)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)] + [(99, None)], "i int, y double")
    row = describe.trends(df, [], "y", ["i"]).first()
    slope, _ = np.polyfit(np.arange(40), y, 1)
    r = np.corrcoef(np.arange(40), y)[0, 1]
    assert row["slope"] == pytest.approx(slope) and row["r_squared"] == pytest.approx(r * r)
    assert row["trend"] == "increasing" and row["is_significant"] and row["points"] == 40


def test_constant_trend(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(6)], "i int, y double")
    row = describe.trends(df, [], "y", ["i"]).first()
    assert (row["slope"], row["r_squared"], row["trend"], row["is_significant"]) == (0.0, 0.0, "decreasing", False)
    assert row["p_value"] == pytest.approx(1.0)


def test_attach_matches_missing_keys(spark):
    left = spark.createDataFrame([(None, 1), (7, 2)], "k int, v int")
    right = spark.createDataFrame([(None, 10), (7, 20)], "k int, s int")
    assert sorted((r["v"], r["s"]) for r in attach(left, right, ["k"]).collect()) == [(1, 10), (2, 20)]
    assert attach(left, right.agg(F.sum("s").alias("s")), []).agg(F.min("s")).first()[0] == 30


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (10,), (100,), (500,)], "heart_rate int")
    assert [r[0] for r in clean.clip_ranges(df).collect()] == [None, 30, 100, 220]


def test_duplicates_are_null_safe(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert tuple(clean.duplicate_rows(df).first()) == (3, 1)


def test_zero_fill_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "n double, f boolean, t string")
    assert tuple(missing.zero_fill(df).first()) == (0.0, False, None)


def test_mode_fill_unknown(spark):
    from vitalgrid.plans.series import Series

    df = spark.createDataFrame([(1, 0, None), (2, 0, "b"), (2, 1, None)], "k int, i int, c string")
    got = missing.mode_fill(Series.of(df, ["k"], ["i"]), ["c"]).done()
    assert sorted(r["c"] for r in got.collect()) == ["b", "b", "unknown"]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Heart Rate` int, Pulse int, `Some-Thing` int")
    with pytest.raises(ValueError):
        columns.standardize_columns(df)
    assert columns.standardize_columns(df.drop("Pulse")).columns == ["heart_rate", "some_thing"]
    assert columns.standardize_columns(spark.range(1).toDF("HR"), map_first=True).columns == ["hr"]
    assert columns.standardize_columns(spark.range(1).toDF("HR")).columns == ["heart_rate"]


def test_detect_timestamp(spark):
    df = spark.createDataFrame([(72, "no", "2024-01-01 10:00:00")], "v int, note string, seen string")
    assert columns.detect_timestamp_column(df) == "seen"
    assert columns.detect_timestamp_column(df.withColumnRenamed("note", "DATE")) == "DATE"
    with pytest.raises(ValueError):
        columns.detect_timestamp_column(df.select("v", "note"))


def test_unknown_metric_is_empty(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 70)], "k int, timestamp string, heart_rate int")
    assert columns.metric_values(df, "heart_rate", ["k"]).count() == 1
    assert columns.metric_values(df, "mood", ["k"]).count() == 0
    assert columns.metric_values(df, "steps", ["k"]).count() == 0


def test_quality_score_single_table(spark):
    rows = [(i, float(i)) for i in range(9)] + [(9, 1000.0), (9, 1000.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "a int, b double")
    pdf = pd.DataFrame(rows, columns=["a", "b"])

    def outliers(s):
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        return ((s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))).sum() / len(s)

    want = (1 - 1 / 24) * 40 + (1 - 1 / 12) * 30 + (1 - np.mean([outliers(pdf["a"]), outliers(pdf["b"])])) * 30
    assert quality.data_quality_score(df).first()[0] == pytest.approx(round(want, 2))


def test_quick_check_flags_missing_time(spark):
    row = quality.quick_check(spark.createDataFrame([("a", "b")], "x string, y string")).first()
    assert not row["is_valid"] and row["issues"] == ["No timestamp column found"]
    assert row["warnings"] == ["No numeric columns found"]


def test_frequency_names(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(seconds=s * i)) for k, s, n in (("a", 30, 5), ("b", 900, 5), ("c", 5400, 5), ("d", 1, 1)) for i in range(n)]
    got = {r["k"]: r["frequency"] for r in align.detect_frequency(spark.createDataFrame(rows, "k string, ts timestamp"), ["k"], "ts").collect()}
    assert got == {"a": "30sec", "b": "15min", "c": "1.5hour", "d": "insufficient_data"}


def test_align_keeps_series_that_would_explode(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("slow", start + dt.timedelta(hours=5 * i), 60.0 + i) for i in range(6)]
    rows += [("fast", start + dt.timedelta(seconds=90 * i), 60.0 + i) for i in range(6)]
    df = spark.createDataFrame(rows, "k string, timestamp timestamp, heart_rate double")
    aligned, report = align.align(df, ["k"], "heart_rate", target="1 min")
    counts = {r["k"]: r["count"] for r in aligned.groupBy("k").count().collect()}
    assert counts == {"slow": 6, "fast": 8}
    assert {r["k"]: r["resampled_rows"] for r in report.collect()} == counts
    values = [r["heart_rate"] for r in aligned.filter("k = 'fast'").orderBy("timestamp").collect()]
    want = pd.Series([60.0 + i for i in range(6)], pd.DatetimeIndex([start + dt.timedelta(seconds=90 * i) for i in range(6)]))
    want = want.resample("1min").mean().interpolate("time", limit_direction="both")
    assert values == pytest.approx(want.tolist())


def test_daylight_saving_edges(spark):
    rows = [(1, dt.datetime(2024, 3, 10, 2, 30)), (2, dt.datetime(2024, 11, 3, 1, 30)), (3, dt.datetime(2024, 7, 1, 12, 0))]
    df = spark.createDataFrame(rows, "i int, ts timestamp_ntz").withColumn("zone", zones.zone_of(F.lit("near New York")))
    got = {r["i"]: r for r in zones.normalize_timestamps(df, "ts", F.col("zone")).collect()}
    assert got[1]["timestamp_utc"] == dt.datetime(2024, 3, 10, 7, 30) and got[1]["nonexistent_shifted"]
    assert got[2]["timestamp_utc"] == dt.datetime(2024, 11, 3, 5, 30) and got[2]["ambiguous"]
    assert got[3]["timestamp_utc"] == dt.datetime(2024, 7, 1, 16, 0) and not got[3]["ambiguous"]
    marked = zones.mark_daylight_saving(df, "ts", F.col("zone")).filter("i = 3").first()
    assert marked["is_dst"] and marked["dst_offset"] == 1.0


def test_findings_text(spark):
    df = spark.createDataFrame([(1, 50), (1, 200)], "k int, heart_rate int")
    got = {r["code"]: r["finding"] for r in describe.findings(df, ["k"], "heart_rate").collect()}
    assert set(got) == {"hr_high", "hr_variable", "hr_peak"} and "125 bpm" in got["hr_high"]
    steps = spark.createDataFrame([(1, 400)], "k int, step_count int")
    assert "9,600 more" in describe.findings(steps, ["k"], "steps").first()["finding"]
    assert describe.findings(steps, ["k"], "sleep").count() == 0


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0)], "k int, v double")
    assert [r["records"] for r in describe.histogram(df, ["k"], "v", 3).orderBy("bin").collect()] == [2, 0, 0]


@pytest.mark.parametrize("n, size, windows", [(9, None, 0), (10, 7, 2), (15, 15, 1), (59, 30, 2), (60, 60, 1), (121, 60, 3)])
def test_window_sizes(spark, n, size, windows):
    df = spark.range(n).select(F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    assert features.window_sizes(df, [], "v").first()["window_size"] == size
    got = features.to_windows(df, [], "v", ["i"]).groupBy("window_id").count().collect()
    assert len(got) == windows and all(r["count"] == size for r in got)


def test_constant_window_features(spark):
    df = spark.range(60).select(F.col("id").alias("i"), F.lit(4.0).alias("v"))
    row = features.window_features(features.to_windows(df, [], "v", ["i"]), []).first()
    assert row["value__skewness"] == 0 and row["value__kurtosis"] == 0 and row["value__autocorrelation__lag_1"] is None


def test_top_and_constant_features(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0), (2.0, 9.0, 5.0)], "value__a double, value__b double, value__c double")
    assert features.constant_columns(df) == ["value__c"]
    assert [r["feature"] for r in features.top_features(df, 2).collect()] == ["value__b", "value__a"]


def seasonal(spark, n=400):
    rng = np.random.default_rng(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for key in (1, 2):
        for i in range(n):
            day = (i * 37 % 1440) / 1440
            value = 60 + key * 0.05 * i + 8 * math.sin(2 * math.pi * day) + rng.normal() * 0.1
            rows.append((key, start + dt.timedelta(minutes=37 * i), value))
    return spark.createDataFrame(rows, "k int, ts timestamp, v double")


def test_seasonal_trend_in_parts_equals_whole(spark):
    train = forecast.training_frame(seasonal(spark), ["k"], "ts", "v")
    whole = {r["k"]: r for r in forecast.fit_seasonal_trend(train, ["k"]).collect()}
    spark.conf.set("spark.vitalgrid.maxSeriesRows", "50")
    parts = {r["k"]: r for r in forecast.fit_seasonal_trend(train, ["k"]).collect()}
    spark.conf.unset("spark.vitalgrid.maxSeriesRows")
    for k, row in whole.items():
        assert row["beta"] == pytest.approx(parts[k]["beta"], abs=1e-6)
        assert row["sigma"] == pytest.approx(parts[k]["sigma"], abs=1e-6) and row["sigma"] < 0.5


@pytest.mark.parametrize("model", ["seasonal_trend", "hour_profile"])
def test_fit_and_predict(spark, model):
    predicted, residuals, report = forecast.fit_and_predict(seasonal(spark), ["k"], "heart_rate", "ts", "v", 100, model)
    assert predicted.filter("is_future").count() == 200 and predicted.filter("yhat is null").count() == 0
    rows = report.collect()
    assert all(r["success"] and r["mae"] < 3 and r["training_rows"] == 400 for r in rows)
    assert residuals.count() == 800


def test_residuals_take_one_exchange(spark):
    """Rows and forecast meet on one exchange; null keys, rows without a forecast and repeated times included."""
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(minutes=i // 2), float(i % 5 + 40 * (i == 9))) for k in ("a", None) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    ahead = [(k, start + dt.timedelta(minutes=i), 2.0, 0.0, 30.0) for k in ("a", None, "other") for i in range(2, 40)]
    expected = spark.createDataFrame(ahead, "k string, ts timestamp, yhat double, yhat_lower double, yhat_upper double")
    flagged = anomaly.flag_residuals(df, expected, ["k"], "ts", "v", 2.0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = flagged.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1
    got = flagged.toPandas()
    spark.conf.set("spark.vitalgrid.maxSeriesRows", "20")
    try:
        joined = anomaly.flag_residuals(df, expected, ["k"], "ts", "v", 2.0).toPandas()
    finally:
        spark.conf.unset("spark.vitalgrid.maxSeriesRows")
    assert len(got) == 60 and got["predicted"].isna().sum() == 8
    hits = got[got["residual_anomaly"]]
    assert len(hits) == 2 and set(hits["v"]) == {44.0} and hits["k"].isna().sum() == 1
    order = ["k", "ts", "v"]
    pd.testing.assert_frame_equal(
        got.sort_values(order).reset_index(drop=True), joined.sort_values(order).reset_index(drop=True)
    )


def test_only_columns_with_gaps_are_ranked(spark, monkeypatch):
    ranked = []
    real = features.quantiles
    monkeypatch.setattr(features, "quantiles", lambda df, by, columns, *a: ranked.extend(columns) or real(df, by, columns, *a))
    rows = [(1.0, 5.0, float("inf"), None), (2.0, None, 3.0, None), (3.0, 7.0, 4.0, None), (4.0, float("nan"), 4.0, None)]
    df = spark.createDataFrame(rows, "feature_a double, feature_b double, feature_c double, feature_d double")
    got = sorted(tuple(r) for r in features.impute(df, columns=df.columns).collect())
    assert got == [(1.0, 5.0, 4.0, 0.0), (2.0, 6.0, 3.0, 0.0), (3.0, 7.0, 4.0, 0.0), (4.0, 6.0, 4.0, 0.0)]
    assert ranked == ["feature_b", "feature_d"]


def test_forecast_of_short_series_is_reported(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 5.0)], "k int, ts timestamp, v double")
    predicted, _residuals, report = forecast.fit_and_predict(df, ["k"], "steps", "ts", "v", model="hour_profile")
    assert predicted.count() == 0
    row = report.first()
    assert not row["success"] and row["error"] == "Insufficient data for modeling"


def brute_dbscan(x, eps, need):
    near = [np.flatnonzero(((x - p) ** 2).sum(axis=1) <= eps * eps) for p in x]
    labels, current = np.full(len(x), -1), 0
    seen = np.zeros(len(x), bool)
    for i in range(len(x)):
        if seen[i] or len(near[i]) < need:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] == -1:
                labels[j] = current
            if seen[j] or len(near[j]) < need:
                continue
            seen[j] = True
            stack += [k for k in near[j] if not seen[k] or labels[k] == -1]
        current += 1
    return labels


@pytest.mark.parametrize("tile", [4, 1024])
def test_dbscan_with_copies(spark, tile, monkeypatch):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(0, 0.3, (40, 4)), rng.normal(3, 0.3, (25, 4)), rng.uniform(-6, 6, (10, 4)), np.ones((30, 4)) * 5])
    from vitalgrid.operators import cluster as module
    from vitalgrid.plans import tiles

    monkeypatch.setattr(module, "compare_tiles", lambda *a, **k: tiles.compare_tiles(*a, **k, tile=tile))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, vec array<double>")
    labels, report = cluster.dbscan(df, "id", "vec", 0.6, 5)
    got = [r["cluster"] for r in labels.orderBy("id").collect()]
    want = brute_dbscan(x, 0.6, 5)
    assert got == want.tolist()
    row = report.first()
    assert row["n_clusters"] == want.max() + 1 and row["n_noise_points"] == (want == -1).sum()


@pytest.mark.parametrize("dimensions", [1, 2, 3, 6])
def test_dbscan_of_dense_places(spark, dimensions, monkeypatch):
    """Full small cells, bands a little less and a little more than eps apart, and thin places between them."""
    from vitalgrid.operators import cluster as module
    from vitalgrid.plans import tiles

    monkeypatch.setattr(module, "FEW", 3)
    monkeypatch.setattr(module, "compare_tiles", lambda *a, **k: tiles.compare_tiles(*a, **k, tile=32))
    rng = np.random.default_rng(dimensions)
    blocks = [rng.uniform(0, 0.45, (80, dimensions)), rng.normal(4, 0.2, (60, dimensions)), rng.uniform(-3, 7, (40, dimensions))]
    for start, gap in ((10, 0.49), (20, 0.51)):  # two plates, one pair of points across the gap
        plates = [rng.uniform(0, 0.4, (60, dimensions)), rng.uniform(0, 0.4, (60, dimensions))]
        plates[1][:, 0] += 0.4 + gap
        plates[0][0], plates[1][0] = 0.2, 0.2
        plates[0][0][0], plates[1][0][0] = 0.4, 0.4 + gap
        blocks += [p + start for p in plates]
    x = np.vstack(blocks)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, vec array<double>")
    labels, _report = cluster.dbscan(df, "id", "vec", 0.5, 5)
    got = [r["cluster"] for r in labels.orderBy("id").collect()]
    assert got == brute_dbscan(x, 0.5, 5).tolist()


def test_dbscan_without_spread(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(7)], "id long, vec array<double>")
    labels, _report = cluster.dbscan(df, "id", "vec", 0.5, 5)
    assert {r["cluster"] for r in labels.collect()} == {0}
    assert cluster.dbscan(df.limit(0), "id", "vec", 0.5, 5)[0].count() == 0


def test_dense_cell_costs_in_proportion(spark, monkeypatch):
    """Points of a full cell are not compared with each other: tiles hold its boxes only."""
    from vitalgrid.operators import cluster as module
    from vitalgrid.plans import tiles

    dealt = []

    def counted(points, *a, **k):
        dealt.append(points.count())
        return tiles.compare_tiles(points, *a, **k)

    monkeypatch.setattr(module, "compare_tiles", counted)
    df = spark.range(20_000).select("id", F.array(F.rand(1) * 0.49, F.rand(2) * 0.49).alias("vec"))
    labels, _report = cluster.dbscan(df, "id", "vec", 0.5, 5)
    assert labels.filter("cluster <> 0").count() == 0 and max(dealt) < 200


def test_long_chain_is_one_cluster(spark):
    df = spark.createDataFrame([(i, [i * 0.4]) for i in range(120)], "id long, vec array<double>")
    labels, _report = cluster.dbscan(df, "id", "vec", 0.5, 2)
    assert labels.select("cluster").distinct().count() == 1


def test_cluster_measures(spark):
    rng = np.random.default_rng(2)
    x, label = rng.normal(size=(50, 3)), rng.integers(0, 3, 50)
    label[0] = 7
    df = spark.createDataFrame([(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(x, label))], "id long, vec array<double>, cluster int")
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i in range(50):
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = apart[i][own].sum() / (own.sum() - 1)
        b = min(apart[i][label == c].mean() for c in set(label) if c != label[i])
        scores.append((b - a) / max(a, b))
    assert cluster.silhouette(df).first()[0] == pytest.approx(np.mean(scores))
    centres = {c: x[label == c].mean(axis=0) for c in set(label)}
    spread = {c: np.linalg.norm(x[label == c] - centres[c], axis=1).mean() for c in centres}
    worst = [max((spread[c] + spread[o]) / np.linalg.norm(centres[c] - centres[o]) for o in centres if o != c) for c in centres]
    assert cluster.davies_bouldin(df).first()[0] == pytest.approx(np.mean(worst))


def test_kmeans_and_report(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(m, 0.1, (20, 2)) for m in (0, 5, 10)])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    rows, report = cluster.cluster_features(df, "id", ["a", "b"], "steps", k=3)
    sizes = sorted(r["count"] for r in rows.groupBy("cluster").count().collect())
    row = report.first()
    assert sizes == [20, 20, 20] and row["n_labels"] == 3 and row["silhouette_score"] > 0.9
    few, small = cluster.kmeans(cluster.with_vector(df.limit(2), ["a", "b"]), 3)
    assert small.first()["actual_clusters"] == 2 and few.count() == 2


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 4)) * [5, 2, 1, 0.5]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, vec array<double>")
    rows, report = cluster.pca(df)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    ratios = values[::-1] / values.sum()
    assert [r["explained_variance_ratio"] for r in report.orderBy("component").collect()] == pytest.approx(ratios[:2].tolist())
    first = vectors[:, -1] * np.sign(vectors[np.abs(vectors[:, -1]).argmax(), -1])
    got = [r["pc1"] for r in rows.orderBy("id").collect()]
    assert got == pytest.approx(((x - x.mean(axis=0)) @ first).tolist())


def test_threshold_rules(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([130] * 11 + [70] + [30] * 10)], "i int, heart_rate int")
    got = anomaly.flag_thresholds(df, [], "heart_rate", ["i"]).orderBy("i").collect()
    assert [r["i"] for r in got if r["threshold_anomaly"]] == [9, 10, 21]
    assert got[9]["anomaly_reason"] == "High heart_rate (>120)" and got[21]["anomaly_reason"] == "Low heart_rate (<40)"
    assert [r["severity"] for r in (got[9], got[21], got[0])] == ["High", "Medium", "Normal"]
    assert anomaly.flag_thresholds(df, [], "mood", ["i"]) is df


def test_cluster_rule(spark):
    df = spark.createDataFrame([(i, -1 if i == 0 else 1 if i < 4 else 0) for i in range(100)], "i int, cluster int")
    flagged = anomaly.flag_clusters(df)
    reasons = {r["cluster"]: r["cluster_anomaly_reason"] for r in flagged.collect()}
    assert reasons == {-1: "Noise point (DBSCAN)", 1: "Belongs to small cluster #1", 0: ""}
    row = anomaly.cluster_flag_report(flagged, [], "steps").first()
    assert (row["total_clusters"], row["anomalous_clusters"], row["anomalies_detected"]) == (3, 2, 4)
    sizes = {r["cluster"]: (r["records"], r["anomalous"]) for r in anomaly.cluster_distribution(flagged).collect()}
    assert sizes == {-1: (1, True), 1: (3, True), 0: (96, False)}


def test_measures_over_many_blocks_of_clusters(spark, monkeypatch):
    """More clusters than one block holds: the same numbers, and no row holds them all."""
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 40, 300)
    x = rng.normal(size=(300, 3)) + labels[:, None]
    df = spark.createDataFrame([(int(c), v.tolist()) for c, v in zip(labels, x)], "cluster int, vec array<double>")
    whole = cluster.silhouette_squared(df).first()[0], cluster.davies_bouldin(df).first()[0]
    monkeypatch.setattr(cluster, "CENTRES", 7)
    assert cluster.cluster_table(df).agg(F.max("block")).first()[0] == 5
    parts = cluster.silhouette_squared(df).first()[0], cluster.davies_bouldin(df).first()[0]
    assert parts == pytest.approx(whole)
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(labels):
        means = {c: apart[i, labels == c].sum() / max((labels == c).sum() - (c == own), 1) for c in set(labels)}
        a, b = means.pop(own), min(means.values())
        scores.append((b - a) / max(a, b) if (labels == own).sum() > 1 else 0.0)
    assert whole[0] == pytest.approx(np.mean(scores))


def test_kmeans_in_passes_and_in_one_block(spark, monkeypatch):
    """Rows over several tasks are fitted pass by pass, those of one block in one task: the same clusters."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=4) + 4 * (i % 3)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    one, report = cluster.kmeans(df, 3, id="id")
    monkeypatch.setattr(cluster, "ROWS_PER_TASK", 90)
    many, spread = cluster.kmeans(df, 3, id="id")
    first, second = ({r["id"]: r["cluster"] for r in d.collect()} for d in (one, many))
    assert first == second and {first[i] for i in range(3)} == {0, 1, 2} and all(first[i] == first[i % 3] for i in first)
    a, b = report.first(), spread.first()
    assert a["inertia"] == pytest.approx(b["inertia"]) and a["converged"] and b["converged"]
    x = np.array([v for _, v in rows])
    cost = sum(((x[[i % 3 == c for i in range(400)]] - x[[i % 3 == c for i in range(400)]].mean(axis=0)) ** 2).sum() for c in range(3))
    assert a["inertia"] == pytest.approx(cost, rel=1e-3)


def test_kmeans_with_fewer_points_than_clusters(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id long, vec array<double>")
    labels, report = cluster.kmeans(same, 3, id="id")
    assert {r["cluster"] for r in labels.collect()} == {0} and report.first()["inertia"] == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [5.0])], "id long, vec array<double>")
    labels, report = cluster.kmeans(two, 3, id="id")
    assert [r["cluster"] for r in labels.orderBy("id").collect()] == [0, 1] and report.first()["actual_clusters"] == 2


def test_validate_reports(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(1, i, start + dt.timedelta(minutes=i), 70 + i % 3 if i % 5 else None) for i in range(20)]
    rows += [(1, 20, start, 300), (1, 21, None, 70), (1, 22, dt.datetime(2001, 1, 1), 70), (1, 23, dt.datetime(2030, 1, 1), 70)]
    df = spark.createDataFrame(rows, "k int, seq int, timestamp timestamp, heart_rate int")
    checked = stages.validate(df, ["k"], order=["timestamp", "seq"], as_of="2025-01-01")
    row = checked.reports["validation"].first()
    assert (row["original_rows"], row["final_rows"], row["duplicates_removed"]) == (24, 20, 1)
    assert row["issues"] == 4 and len(row["issue_list"]) == 4
    assert checked.data.filter("heart_rate is null").count() == 0
    by_column = {r["column"]: r for r in checked.reports["missing"].collect()}
    assert by_column["heart_rate"]["missing_before"] == 4 and by_column["heart_rate"]["missing_after"] == 0


def test_report_json_of_nested_flatten(spark):
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps({"a": {"b": {"c": 1}, "d": [1, 2]}, "e": "x"})]))
    assert columns.flatten(df).columns == ["a.b.c", "a.d", "e"]


def test_seasonal_prediction_is_the_design_times_its_coefficients(spark):
    """Pieces of the trend and the recurrence of the waves give what the whole design matrix gives."""
    rng = np.random.default_rng(3)
    start = dt.datetime(2024, 1, 1, 5)
    seconds = np.sort(rng.integers(0, 9 * 86_400, 300))
    rows = [(start + dt.timedelta(seconds=int(s)), float(60 + 8 * np.sin(s / 9000) + s / 50_000 + rng.normal())) for s in seconds]
    train = spark.createDataFrame(rows, "ts timestamp, y double")
    for shape in (forecast.SHAPE, forecast.Shape(0, 1), forecast.Shape(3, 0)):
        model = forecast.fit_seasonal_trend(train, [], shape=shape)
        found = forecast.predict_seasonal_trend(model, forecast.future_grid(train, [], 50), [], shape)
        got = {r["ts"]: r["yhat"] for r in found.collect()}
        m = model.first()
        us = np.array([int((ts - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000 for ts in got])
        design = shape.design((us - m["start_us"]) / m["length_us"], us % forecast.DAY_US / forecast.DAY_US)
        assert len(got) >= 300 and list(got.values()) == pytest.approx(m["level"] + design @ np.array(m["beta"]), abs=1e-8)


def test_distances_by_product():
    """A matrix product decides like sums by dimension, also at the limit, for copies and far from the origin."""
    from vitalgrid.plans import tiles

    rng = np.random.default_rng(5)
    for shift in (0.0, 1e6):
        a = rng.integers(-2, 3, (60, 20)) * 0.25 + shift
        b = np.vstack([a[:20], rng.integers(-2, 3, (50, 20)) * 0.25 + shift])
        squares = tiles.squared_distances(a, b)
        for limit in (0.0, 1.0, float(np.median(squares))):
            assert (tiles.within(a, b, limit) == (squares <= limit)).all()
        assert np.allclose(tiles.distances(a, b), np.sqrt(squares), rtol=1e-10, atol=0)
    b[3, 1] = np.inf
    assert (tiles.within(a, b, 1.0) == (tiles.squared_distances(a, b) <= 1.0)).all()


def test_dbscan_of_crowded_cells(spark, monkeypatch):
    """Tiles of crowded cells do not all meet: in many dimensions cells divide nothing, and the comparisons of tiles
    grew with the square of the points."""
    from vitalgrid.operators import cluster as module
    from vitalgrid.plans import tiles

    met = []

    def counted(points, evaluate, schema, *a, **k):
        tally = spark.sparkContext.accumulator(0)

        def one(x, y, same):
            tally.add(1)
            return evaluate(x, y, same)

        met.append(tally)
        return tiles.compare_tiles(points, one, schema, *a, **k, tile=16)

    monkeypatch.setattr(module, "compare_tiles", counted)
    monkeypatch.setattr(module, "TILE", 16)
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0.3, 0.08, (300, 12)), rng.normal(0.9, 0.08, (200, 12)), rng.uniform(0, 1.2, (12, 12))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, vec array<double>")
    pairs = []
    for crowded in (10**9, 8):
        monkeypatch.setattr(module, "CROWDED", crowded)
        met.clear()
        labels, _report = cluster.dbscan(df, "id", "vec", 0.6, 5)
        assert [r["cluster"] for r in labels.orderBy("id").collect()] == brute_dbscan(x, 0.6, 5).tolist()
        pairs.append(sum(t.value for t in met))
    assert pairs[1] < pairs[0]


def test_silhouette_in_large_tiles(spark, monkeypatch):
    """Few tiles of many points, compared block by block: one row per point, label and pair of tiles comes back."""
    monkeypatch.setattr(cluster, "TILE", 8)
    monkeypatch.setattr(cluster, "BLOCK", 8)
    rng = np.random.default_rng(9)
    x, label = rng.normal(size=(600, 12)), rng.integers(0, 3, 600)
    x[1], label[0] = x[0], 9
    df = spark.createDataFrame([(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(x, label))], "id long, vec array<double>, cluster int")
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i in range(600):
        mine = label == label[i]
        a = apart[i][mine].sum() / max(1, mine.sum() - 1)
        b = min(apart[i][label == c].mean() for c in set(label) - {label[i]})
        scores.append(0.0 if mine.sum() == 1 else (b - a) / max(a, b))
    assert abs(cluster.silhouette(df).first()[0] - np.mean(scores)) < 1e-9


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_outliers_of_large_series_are_not_sorted(spark, small_slices):
    """The rows of a large series do not meet their bounds in one task."""
    df = spark.range(60).select((F.col("id") % 2).alias("k"), F.when(F.col("id") > 57, 900.0).otherwise(F.col("id") % 7).alias("v"))
    flagged, _report = quality.flag_outliers(df, ["k"], ["v"])
    assert "SortMergeJoin" not in _plan(flagged) and "BroadcastHashJoin" in _plan(flagged)
    assert flagged.filter("v_is_outlier").count() == 2 and flagged.count() == 60


def test_profile_does_not_sort_values(spark):
    """Distinct values are hashed; with the sample in the same aggregate all values of a task were sorted."""
    df = spark.createDataFrame([(1, "a", 0.0), (2, None, -0.0), (2, "b", 1.5)], "id int, t string, x double")
    profile = quality.column_profile(df, ["id"])
    assert "Sort " not in _plan(profile)
    assert {r["column"]: (r["unique_values"], r["sample"]) for r in profile.collect()} == {"id": (2, "1"), "t": (2, "a"), "x": (2, "0.0")}


def test_profile_in_pieces(spark, small_slices):
    df = spark.range(40).select((F.col("id") % 9).alias("a"), F.col("id").cast("string").alias("b"))
    assert [r["unique_values"] for r in quality.column_profile(df, ["b"]).collect()] == [9, 40]
