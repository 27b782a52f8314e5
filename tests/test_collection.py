"""Folders of mixed files: every file and series has a status, and the stages cover all types."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalgrid.plans import collection as plan
from vitalgrid.plans import series
from vitalgrid.sources import collection


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("files")

    def put(name, text):
        (root / name).write_text(text)

    put("heart_export.csv", "﻿Time,Person,HR_value,Heart Rate\n2024-01-01 00:00:00,a,1,70\n2024-01-01 00:01:00,a,2,abc\n\n\"2024-01-01 00:02:00\",\"b,c\",3,71\n")
    put("sleep.json", '{"data":[{"date":"2024-01-01","person":"a","duration_minutes":400},{"date":"2024-01-02","person":"a","duration_minutes":null,"sleep_stage":"deep"}]}')
    put("bedtime.json", '[{"date":"2024-01-03","person":"a","duration_minutes":5000}]')
    put("rest.json", '{"date":"2024-01-04","person":"a","duration_minutes":"30"}')
    put("steps.jsonl", '{"timestamp":"2024-01-01T00:00:00","person":"a","step_count":5}\nnot json\n{"timestamp":"2024-01-01T00:01:00Z","person":"a","steps":7}\n')
    put("walk.ndjson", '{"timestamp":"never","person":"z","step_count":5}\n')
    put("hr_bad.json", '{"data": [ {')
    put("pulse_only.csv", "timestamp,person\n2024-01-01,a\n")
    put("notes.txt", "timestamp,person,confidence\n2024-01-01,a,0.5\n")
    put("hr_broken.parquet", "this is not parquet")
    put("walk.xlsx", "x")
    put("bed.csv", "date,duration_minutes\n")
    rows = [(dt.datetime(2024, 1, 1, 0, i), "p", 60 + i) for i in range(3)]
    spark.createDataFrame(rows, "timestamp timestamp, Person string, `Heart-Rate` int").write.parquet(str(root / "hr_watch.parquet"))
    return str(root)


@pytest.fixture(scope="module")
def loaded(spark, folder):
    return collection.load(spark, folder, ["person"])


def test_status_of_every_file(loaded):
    found = {r["file_name"]: (r["format"], r["data_type"], r["rows"], r["rescued"], r["unparsed"], r["error"]) for r in loaded.status.collect()}
    assert found == {
        "heart_export.csv": ("csv", "heart_rate", 3, 0, 1, None),
        "sleep.json": ("json", "sleep", 2, 0, 0, None),
        "bedtime.json": ("json", "sleep", 1, 0, 0, None),
        "rest.json": ("json", "sleep", 1, 0, 0, None),
        "steps.jsonl": ("lines", "steps", 2, 1, 0, None),
        "walk.ndjson": ("lines", "steps", 1, 0, 1, None),
        "hr_bad.json": ("json", "heart_rate", 0, 1, 0, "no record can be read"),
        "pulse_only.csv": ("csv", "heart_rate", 1, 0, 0, "missing columns: heart_rate"),
        "notes.txt": ("csv", "unknown", 1, 0, 0, None),
        "hr_broken.parquet": ("parquet", "heart_rate", 0, 0, 0, "no rows can be read"),
        "walk.xlsx": (None, "steps", 0, 0, 0, "unsupported file format .xlsx"),
        "bed.csv": ("csv", "sleep", 0, 0, 0, "no rows can be read"),
        "hr_watch.parquet": ("parquet", "heart_rate", 3, 0, 0, None),
    }


def test_readings_of_every_type(loaded):
    rows = plan.readings(loaded, ["person"]).collect()
    got = sorted((r["data_type"], r["person"], r["metric"], str(r["timestamp"]), r["value"]) for r in rows if r["timestamp"] and r["value"] is not None)
    day = "2024-01-01 00:0%d:00"
    assert got == sorted(
        [("heart_rate", "p", "heart_rate", day % i, 60.0 + i) for i in range(3)]
        + [("heart_rate", "a", "heart_rate", day % 0, 70.0), ("heart_rate", "b,c", "heart_rate", day % 2, 71.0)]
        + [("sleep", "a", "duration_minutes", f"2024-01-0{d} 00:00:00", v) for d, v in ((1, 400.0), (3, 5000.0), (4, 30.0))]
        + [("steps", "a", "step_count", day % 0, 5.0), ("steps", "a", "step_count", day % 1, 7.0), ("unknown", "a", "confidence", day % 0, 0.5)]
    )
    assert len(rows) == len(got) + 3  # two missing values and a time that does not parse


def test_stages(spark, loaded):
    run = plan.analyse(loaded, ["person"], forecaster="hour_profile")
    data = {(r["data_type"], r["person"], str(r["timestamp"])): r["value"] for r in run.first.data.collect()}
    assert data[("sleep", "a", "2024-01-02 00:00:00")] == 400.0  # the median of what is there, after clipping
    assert data[("sleep", "a", "2024-01-03 00:00:00")] == 1440.0
    assert data[("heart_rate", "a", "2024-01-01 00:01:00")] == 70.0
    checks = {(r["data_type"], r["person"]): r for r in run.first.reports["validation"].collect()}
    assert checks[("steps", "z")]["invalid_timestamps"] == 1 and checks[("steps", "z")]["final_rows"] == 0
    assert checks[("sleep", "a")]["out_of_range"] == 1 and checks[("sleep", "a")]["missing_before"] == 1
    aligned = {(r["data_type"], r["person"]): (r["success"], r["error"]) for r in run.first.reports["alignment"].collect()}
    assert aligned[("steps", "z")] == (False, "No rows with a valid time") and aligned[("sleep", "a")] == (True, None)
    models = {(r["data_type"], r["person"]): r["error"] for r in run.second.reports["modeling"].collect()}
    assert models[("unknown", "a")] == "Unknown data type: unknown" and models[("heart_rate", "b,c")] == "Insufficient data for modeling"
    flags = {(r["data_type"], r["person"], r["timestamp"].day): r for r in run.third.data.collect()}
    assert flags[("sleep", "a", 4)]["severity"] == "High" and flags[("sleep", "a", 4)]["anomaly_reason"] == "Insufficient duration_minutes"
    assert flags[("sleep", "a", 3)]["severity"] == "Medium" and flags[("unknown", "a", 1)]["severity"] is None
    status = {(r["source"].rsplit("/", 1)[1], r["person"]): (r["rows"], r["aligned_rows"], r["error"]) for r in run.status.collect()}
    assert status[("walk.ndjson", "z")] == (1, 0, "No rows with a valid time")
    assert status[("hr_bad.json", None)] == (0, 0, "no record can be read") and len(status) == 14


def test_unknown_target_is_reported(loaded):
    stage = plan.preprocess(plan.readings(loaded, ["person"]), ["person"], "2 weeks")
    reports = stage.reports["alignment"].collect()
    assert not any(r["success"] for r in reports) and {r["error"] for r in reports} == {"'2 weeks'", "No rows with a valid time"}
    assert stage.data.count() == 13


def test_folder_without_usable_files(spark, tmp_path):
    (tmp_path / "walk.xlsx").write_text("x")
    nothing = collection.load(spark, str(tmp_path), ["person"])
    assert nothing.records.count() == 0 and nothing.status.count() == 1
    run = plan.analyse(nothing, ["person"])
    assert run.first.data.count() == 0 and run.third.data.count() == 0
    assert [r["error"] for r in run.status.collect()] == ["unsupported file format .xlsx"]


def test_no_job_per_file(spark, tmp_path):
    """The number of jobs does not depend on the number of files."""
    jobs = []
    for n in (2, 12):
        root = tmp_path / str(n)
        root.mkdir()
        for i in range(n):
            (root / f"hr_{i}.csv").write_text("timestamp,person,heart_rate\n2024-01-01,a,7\n")
            (root / f"steps_{i}.json").write_text('[{"timestamp":"2024-01-01","person":"a","step_count":7}]')
        spark.sparkContext.setJobGroup(f"load-{n}", "load")
        status = collection.load(spark, str(root), ["person"]).status
        assert status.filter("success").count() == 2 * n
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"load-{n}")))
    spark.sparkContext.setJobGroup("tests", "")
    assert jobs[0] == jobs[1]


def test_heads_without_sorting_lines(spark, tmp_path):
    """The head of a CSV file is found by its line number; an aggregate of texts sorted all lines of the file's first block."""
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"\nTime,Person,Heart Rate\n2024-01-01 00:00:00,{name},70\nTime,Person,Heart Rate\n2024-01-01 00:01:00,{name},71\n")
    rows = collection._csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["person"])
    assert "SortAggregate" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["person"], r["heart_rate"]) for r in rows.collect()) == [("a", 70.0), ("a", 71.0), ("b", 70.0), ("b", 71.0)]


def test_tasks_hold_few_slices(spark, monkeypatch):
    rows = spark.range(3000).selectExpr(
        "'heart_rate' as data_type", "'p' as person", "'heart_rate' as metric",
        "timestamp_seconds(1704067200 + id * 60) as timestamp", "'f' as source", "0L as block", "id as line", "60D + id % 5 as value",
    )
    whole = sorted(plan.preprocess(rows, ["person"]).data.collect())
    monkeypatch.setattr(series, "SLICE_ROWS", 100)
    spark.conf.set(series.MAX_ROWS_CONF, "8000")  # a series of 3,000 wide rows is large
    try:
        cut = series.Series.of(rows, ["person"], ["timestamp"], True).df
        held = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 3000 and max(held) <= 600
        assert sorted(plan.preprocess(rows, ["person"]).data.collect()) == whole
    finally:
        spark.conf.unset(series.MAX_ROWS_CONF)
