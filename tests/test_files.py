"""Reading, writing, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from vitalgrid.sources import readers, writers
from vitalgrid.streaming import incremental


def put(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = put(tmp_path / "heart.csv", "timestamp,heart_rate\n2024-01-01 06:00:00,70\nbad,71\n", "utf-8-sig")
    df = readers.read_csv(spark, path, "timestamp string, heart_rate int", "timestamp")
    assert df.columns == ["timestamp", "heart_rate"]
    assert [r["timestamp"] is None for r in df.orderBy("heart_rate").collect()] == [False, True]


@pytest.mark.parametrize("wrap", [lambda r: r, lambda r: {"data": r}, lambda r: {"records": r}, lambda r: {"entries": r, "device": "w"}])
def test_json_shapes(spark, tmp_path, wrap):
    records = [{"hr": 70, "at": {"hour": 6}}, {"hr": 71, "at": {"hour": 7}}]
    df = readers.read_json(spark, put(tmp_path / "x.json", json.dumps(wrap(records))))
    assert sorted(df.columns) == ["at.hour", "hr"] and df.count() == 2


def test_single_json_object(spark, tmp_path):
    assert readers.read_any(spark, put(tmp_path / "x.json", '{"hr": 70}')).count() == 1


def test_unsupported_and_empty(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.format_of("x.xlsx")
    with pytest.raises(ValueError):
        readers.read_any(spark, put(tmp_path / "e.csv", "a,b\n"), schema="a int, b int")


@pytest.mark.parametrize(
    "name, kind",
    [("My_Heart.csv", "heart_rate"), ("sleep_hr.csv", "heart_rate"), ("bedtime.json", "sleep"), ("walks.txt", "steps"), ("mood.csv", "unknown")],
)
def test_type_by_name(spark, name, kind):
    assert readers.data_type_of(f"/heart/{name}") == kind
    assert spark.range(1).select(readers.type_of_name(F.lit(name))).first()[0] == kind


def test_load_files(spark, tmp_path):
    one = put(tmp_path / "hr_1.csv", "Timestamp,HR\n2024-01-01 06:00:00,70\n")
    two = put(tmp_path / "hr_2.csv", "timestamp,heart_rate\n2024-01-01 07:00:00,80\n2024-01-01 07:01:00,81\n")
    bad = put(tmp_path / "steps.csv", "timestamp,other\n2024-01-01 07:00:00,80\n")
    # HR is matched as a part of no required name, so the first file is left out
    found = readers.load_files(spark, [one, two, bad])
    assert set(found) == {"heart_rate"} and found["heart_rate"].count() == 2
    third = put(tmp_path / "heart_3.csv", "timestamp,heart_rate\n2024-01-02 07:00:00,90\n")
    assert readers.load_files(spark, [two, third])["heart_rate"].count() == 3
    assert readers.load_files(spark, [two, third], "last")["heart_rate"].count() == 1


def test_convert_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "k int, v double")
    first = writers.write_table(df, str(tmp_path / "a.parquet"), "parquet")
    second = writers.convert(spark, first, str(tmp_path / "b.csv"), "csv")
    assert [tuple(r) for r in readers.read_any(spark, second).collect()] == [(1, 2.5)]
    with pytest.raises(ValueError):
        writers.write_table(df, str(tmp_path / "c"), "xlsx")
    report = df.select("k", F.struct("v", F.array("k").alias("ks")).alias("nested"))
    assert writers.flatten_report(report).columns == ["k", "nested_v", "nested_ks"]
    with pytest.raises(ValueError):
        writers.export_report(report, str(tmp_path / "d"), "yaml")


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events = events.select("event_id", "user_id", "ts", "value")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = incremental.read_stream(spark, str(tmp_path / "in"), events.schema)
    flagged = incremental.checked_stream(stream, "ts", "value", (5, 60), "2024-01-20 00:00:00")
    incremental.write_available(flagged, str(tmp_path / "flags"), str(tmp_path / "c1"))
    got = spark.read.parquet(str(tmp_path / "flags"))
    want = events.filter("ts <= timestamp'2024-01-20 00:00:00'")
    assert got.count() == want.count()
    assert got.filter("threshold_anomaly").count() == want.filter("value < 5 or value > 60").count()

    bins = incremental.resample_stream(stream, ["user_id"], "ts", 3600, {"value": "mean"})
    query = bins.writeStream.format("memory").queryName("bins").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = events.groupBy("user_id", F.window("ts", "1 hour")).agg(F.avg("value").alias("v"))
    assert spark.table("bins").count() == batch.count()
