"""Ordered operators against pandas, in plain windows and in slices."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import align, anomaly, describe, missing
from vitalgrid.plans.series import Series, has_large_series
from vitalgrid.plans.summaries import mode_of, quantiles


def readings(seed, n, nulls=0.4):
    rng = np.random.default_rng(seed)
    values = np.round(rng.normal(50, 20, n), 2)
    return [None if rng.random() < nulls else float(v) for v in values]


@pytest.fixture(scope="module")
def table(spark):
    """Series 1 holds most rows, series None has no key, series 3 is all null, series 4 one row."""
    rows = []
    for key, n, nulls in ((1, 83, 0.5), (2, 9, 0.3), (None, 31, 0.8), (3, 12, 1.1), (4, 1, 0.0)):
        for i, v in enumerate(readings(n, n, nulls)):
            rows.append((key, i, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=i * i % 977 + i), v))
    frame = pd.DataFrame(rows, columns=["k", "seq", "ts", "v"]).astype({"k": "Int64"})
    frame["v"] = frame["v"].astype(float)
    df = spark.createDataFrame(
        [(None if pd.isna(r.k) else int(r.k), r.seq, r.ts.to_pydatetime(), None if pd.isna(r.v) else r.v) for r in frame.itertuples()],
        "k long, seq long, ts timestamp, v double",
    ).repartition(5)
    return df, frame


@pytest.fixture(params=["plain", "sliced"])
def layout(request, spark):
    if request.param == "sliced":
        spark.conf.set("spark.vitalgrid.maxSeriesRows", "7")
    yield request.param
    spark.conf.unset("spark.vitalgrid.maxSeriesRows")


def by_key(df, column, order="seq"):
    out = {}
    for row in df.orderBy(order).collect():
        out.setdefault(row["k"], []).append(row[column])
    return out


def expected(frame, fn, order="seq"):
    out = {}
    for key, part in frame.groupby("k", dropna=False):
        part = part.sort_values(order)
        out[None if pd.isna(key) else int(key)] = [None if pd.isna(x) else x for x in fn(part)]
    return out


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert len(a[k]) == len(b[k])
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None), (k, a[k], b[k])
            if x is not None:
                assert x == pytest.approx(y, abs=1e-9)


def test_layout_choice(table, layout):
    assert has_large_series(table[0], ["k"]) == (layout == "sliced")


def test_position(table, layout):
    df, frame = table
    got = Series.of(df, ["k"], ["seq"]).position("pos").size("n").done()
    close(by_key(got, "pos"), expected(frame, lambda p: range(len(p))))
    close(by_key(got, "n"), expected(frame, lambda p: [len(p)] * len(p)))


def test_neighbours(table, layout):
    df, frame = table
    got = Series.of(df, ["k"], ["seq"]).neighbours(previous={"b": F.col("v")}, following={"a": F.col("v")}).done()
    close(by_key(got, "b"), expected(frame, lambda p: p["v"].shift(1)))
    close(by_key(got, "a"), expected(frame, lambda p: p["v"].shift(-1)))


def test_running_total(table, layout):
    df, frame = table
    got = Series.of(df, ["k"], ["seq"]).running_total("t", F.coalesce("v", F.lit(0.0))).done()
    close(by_key(got, "t"), expected(frame, lambda p: p["v"].fillna(0).cumsum()))


def test_interpolate_rows(table, layout):
    df, frame = table
    got = missing.interpolate_rows(Series.of(df, ["k"], ["seq"]), ["v"]).done()
    close(by_key(got, "v"), expected(frame, lambda p: p["v"].interpolate("linear", limit=10).bfill(limit=5)))


def test_interpolate_gap_limits(spark):
    values = [1.0, *[None] * 18, 20.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq int, v double")
    got = missing.interpolate_rows(Series.of(df, [], ["seq"]), ["v"]).done().orderBy("seq").collect()
    filled = [r["v"] for r in got]
    assert filled[1:11] == pytest.approx([2.0 + i for i in range(10)])
    assert filled[11:14] == [None] * 3 and filled[14:19] == [20.0] * 5


def test_interpolate_time(table, layout):
    df, frame = table
    got = missing.interpolate_time(Series.of(df, ["k"], ["ts", "seq"]), ["v"], "ts").done()

    def pandas_way(p):
        s = p.set_index("ts")["v"]
        s = s.astype(float)
        return s.interpolate("time", limit_direction="both") if s.notna().any() else s

    rows = {}
    for r in got.orderBy("ts", "seq").collect():
        rows.setdefault(r["k"], []).append(r["v"])
    close(rows, expected(frame, pandas_way, ["ts", "seq"]))


def test_fills(table, layout):
    df, frame = table
    series = Series.of(df, ["k"], ["seq"])
    close(by_key(missing.forward_fill(series, ["v"]).done(), "v"), expected(frame, lambda p: p["v"].ffill()))
    close(by_key(missing.backward_fill(series, ["v"]).done(), "v"), expected(frame, lambda p: p["v"].bfill()))


def test_quantiles(table, layout):
    df, frame = table
    got = {r["k"]: r["v"] for r in quantiles(df, ["k"], ["v"], [0.25, 0.5, 0.9]).collect()}
    for key, part in frame.groupby("k", dropna=False):
        key = None if pd.isna(key) else int(key)
        want = part["v"].dropna()
        if len(want):
            assert got[key] == pytest.approx(want.quantile([0.25, 0.5, 0.9]).tolist())
        else:
            assert got.get(key) is None


def test_quantiles_without_keys(table, layout):
    df, frame = table
    got = quantiles(df, [], ["v", "seq"], [0.1, 0.5]).first()
    assert got["v"] == pytest.approx(frame["v"].quantile([0.1, 0.5]).tolist())
    assert got["seq"] == pytest.approx(frame["seq"].quantile([0.1, 0.5]).tolist())


def test_mode_takes_smallest_tie(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None)], "k int, c string")
    assert [tuple(r) for r in mode_of(df, ["k"], "c").collect()] == [(1, "a")]


def test_sustained_threshold(table, layout):
    df, frame = table
    rule = (45, 55, 3)
    got = anomaly.flag_thresholds(df, ["k"], "any", ["seq"], "v", rule)

    def pandas_way(p):
        over = ((p["v"] > 55).rolling(3, min_periods=3).sum() >= 3).to_numpy()
        under = ((p["v"] < 45).rolling(3, min_periods=3).sum() >= 3).to_numpy()
        return np.where(under, "Medium", np.where(over, "High", "Normal"))

    assert by_key(got, "severity") == expected(frame, pandas_way)


def brute_extrema(x, p):
    out = []
    i = 1
    while i < len(x) - 1:
        if x[i - 1] < x[i]:
            j = i
            while j < len(x) - 1 and x[j + 1] == x[i]:
                j += 1
            if j < len(x) - 1 and x[j + 1] < x[i]:
                peak = (i + j) // 2
                low = []
                for step, stop in ((-1, -1), (1, len(x))):
                    k, m = peak, x[peak]
                    while k != stop and x[k] <= x[peak]:
                        m = min(m, x[k])
                        k += step
                    low.append(m)
                if x[peak] - max(low) >= p:
                    out.append(peak)
            i = j
        i += 1
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_extrema(spark, layout, seed):
    rng = np.random.default_rng(seed)
    rows, want = [], {}
    for key, n in ((1, 120), (2, 15), (3, 2)):
        x = rng.integers(0, 5, n) + (rng.integers(0, 3, n) / 4)
        rows += [(key, i, float(v)) for i, v in enumerate(x)]
        want[key] = (brute_extrema(x, 1), brute_extrema(-x, 1))
    df = spark.createDataFrame(rows, "k int, seq int, v double").repartition(3)
    found = describe.extrema(df, ["k"], "v", ["seq"]).collect()
    for key, (peaks, valleys) in want.items():
        assert sorted(r["pos"] for r in found if r["k"] == key and r["kind"] == "peak") == peaks
        assert sorted(r["pos"] for r in found if r["k"] == key and r["kind"] == "valley") == valleys


def test_resample_matches_pandas(table, layout):
    df, frame = table
    how = {"v": "mean", "seq": "sum"}
    got = align.resample(df, ["k"], "ts", 300, how, ["ts", "seq"])
    for key, part in frame.groupby("k", dropna=False):
        want = part.set_index("ts").sort_index().resample("5min").agg({"v": "mean", "seq": "sum"})
        match = F.col("k").isNull() if pd.isna(key) else F.col("k") == int(key)
        rows = got.filter(match).orderBy("ts").collect()
        assert [r["ts"] for r in rows] == [t.to_pydatetime() for t in want.index]
        assert [r["seq"] for r in rows] == want["seq"].tolist()
        for r, v in zip(rows, want["v"]):
            assert (r["v"] is None and pd.isna(v)) or r["v"] == pytest.approx(v)


@pytest.mark.parametrize("agg", ["median", "first", "last", "max", "other"])
def test_resample_aggregates(table, layout, agg):
    df, frame = table
    got = align.resample(df, ["k"], "ts", 7 * 60, {"v": agg}, ["ts", "seq"])
    for key, part in frame.groupby("k", dropna=False):
        series = part.sort_values(["ts", "seq"]).set_index("ts")["v"]
        want = getattr(series.resample("7min"), agg if agg != "other" else "mean")()
        match = F.col("k").isNull() if pd.isna(key) else F.col("k") == int(key)
        rows = got.filter(match).orderBy("ts").collect()
        assert [r["ts"] for r in rows] == [t.to_pydatetime() for t in want.index]
        for r, v in zip(rows, want):
            assert (r["v"] is None and pd.isna(v)) or r["v"] == pytest.approx(v)


def test_extrema_without_keys(spark, layout):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 4, 60).astype(float)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "seq int, v double").repartition(3)
    found = describe.extrema(df, [], "v", ["seq"]).collect()
    assert sorted(r["pos"] for r in found if r["kind"] == "peak") == brute_extrema(x, 1)
    assert sorted(r["pos"] for r in found if r["kind"] == "valley") == brute_extrema(-x, 1)


def test_copies_spread_over_slices(spark):
    """One series whose rows are all alike is still cut, and no row is lost."""
    spark.conf.set("spark.vitalgrid.maxSeriesRows", "50")
    try:
        df = spark.range(1000).select(F.lit(1).alias("k"), F.lit(5).alias("t"), F.lit(2.0).alias("v")).repartition(4)
        got = Series.of(df, ["k"], ["t"]).position("pos").running_total("sum", F.col("v"))
        rows = got.done()
        assert got.df.select("_slice").distinct().count() > 4
        assert rows.select("pos").distinct().count() == 1000
        assert rows.filter(F.col("sum") != (F.col("pos") + 1) * 2).count() == 0
    finally:
        spark.conf.unset("spark.vitalgrid.maxSeriesRows")


@pytest.mark.parametrize("limit", ["2", "1000000"])
def test_quantiles_agree_between_layouts(spark, limit):
    """Infinities, NaN and series without any value: the same answer however large a series may be."""
    inf, nan = float("inf"), float("nan")
    rows = [("a", inf), ("a", inf), ("a", 1.0), ("b", None), ("b", None), ("c", nan), ("c", 2.0), ("c", 4.0), ("d", -inf), ("e", nan)]
    df = spark.createDataFrame(rows, "k string, v double")
    spark.conf.set("spark.vitalgrid.maxSeriesRows", limit)
    try:
        found = {r.k: r.v for r in quantiles(df, ["k"], ["v"], [0.25, 0.5, 0.75]).collect()}
    finally:
        spark.conf.unset("spark.vitalgrid.maxSeriesRows")
    assert found == {"a": [inf, inf, inf], "b": None, "c": [2.5, 3.0, 3.5], "d": [-inf] * 3, "e": None}
