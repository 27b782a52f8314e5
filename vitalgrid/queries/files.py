"""Reading and writing files. The inputs are files that Spark writes from the test tables."""

from pyspark.sql import functions as F

from vitalgrid.operators import anomaly, columns
from vitalgrid.queries.anomalies import INSTANT, SUSTAINED, instant, reports, sustained
from vitalgrid.queries.registry import R, query
from vitalgrid.session import scratch_path
from vitalgrid.sources import readers, writers

READING = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
ROWS = f"SELECT event_id, ts, user_id, event_type, {R('value')} AS value FROM events"


def readings(t):
    return t.events.select("event_id", "ts", "user_id", "event_type", "value")


def written(t, fmt: str, extension: str | None = None, df=None) -> str:
    path = scratch_path(t.spark, "files") + f".{extension or fmt}"
    return writers.write_table(readings(t) if df is None else df, path, fmt)


@query("s1_csv_scan", ROWS)
def _(t):
    return readers.read_csv(t.spark, written(t, "csv"), READING)


@query(
    "s1_csv_date_column",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS timestamp FROM events
    """,
)
def _(t):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    path = written(t, "csv", df=t.events.select("event_id", text.alias("timestamp")))
    return readers.read_csv(t.spark, path, "event_id long, timestamp string", "timestamp")


@query("s2_text_scan", ROWS)
def _(t):
    return readers.read_any(t.spark, written(t, "csv", "txt"), schema=READING)


@query("s3_json_wrapped", ROWS)
def _(t):
    record = F.struct(*readings(t).columns)
    wrapped = readings(t).select(F.lit("device").alias("source"), F.array(record).alias("data"))
    path = written(t, "json", df=wrapped)
    schema = f"source string, data array<struct<{READING.replace(' long', ':long').replace(' timestamp_ntz', ':timestamp_ntz').replace(' string', ':string').replace(' double', ':double')}>>"
    return readers.read_json(t.spark, path, schema, lines=True)


def json_files(t, whole) -> str:
    """A file for each event type, with one JSON value over its rows."""
    path = scratch_path(t.spark, "files") + ".json"
    record = F.struct("event_id", F.array("user_id").alias("data"))
    rows = t.events.groupBy("event_type").agg(whole(F.collect_list(record)).alias("value"))
    rows.write.partitionBy("event_type").text(path)
    return path


SHAPES = "SELECT event_id, event_type, user_id FROM events"


@query("s3_json_list", SHAPES)
def _(t):
    path = json_files(t, F.to_json)
    df = readers.read_json(t.spark, path, "event_id long, data array<long>, event_type string")
    return df.select("event_id", "event_type", F.col("data")[0].alias("user_id"))


@query("s3_json_object", "SELECT event_type, count(*) AS records FROM events GROUP BY event_type")
def _(t):
    path = json_files(t, lambda found: F.to_json(F.struct(F.size(found).alias("records"))))
    return readers.read_json(t.spark, path, "records long, event_type string").select("event_type", "records")


@query("s3_json_records", ROWS)
def _(t):
    return readers.read_json(t.spark, written(t, "json"), READING, lines=True)


@query(
    "s4_flatten",
    f"""
    SELECT event_id, user_id, event_type AS reading_kind, {R('value')} AS reading_detail_value, (props->>'k')::bigint AS reading_detail_k, [event_type] AS tags
    FROM events
    """.replace("[event_type] AS tags", "event_type AS tags"),
)
def _(t):
    k = F.from_json("props", "k long")["k"]
    nested = t.events.select(
        "event_id",
        F.struct(F.col("user_id").alias("id")).alias("user"),
        F.struct(
            F.col("event_type").alias("kind"), F.struct(F.col("value"), k.alias("k")).alias("detail")
        ).alias("reading"),
        F.array("event_type").alias("tags"),
    )
    path = written(t, "json", df=nested)
    flat = readers.read_json(t.spark, path, lines=True)
    flat = flat.toDF(*[c.replace(".", "_") for c in flat.columns])
    return flat.withColumn("tags", F.array_join("tags", ","))


@query(
    "s5_parquet_scan",
    f"SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, {R('l_extendedprice')} AS l_extendedprice FROM lineitem",
)
def _(t):
    df = readers.read_parquet(t.spark, f"{t.folder}/lineitem.parquet")
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "s6_format_dispatch",
    " UNION ALL ".join(
        f"SELECT '{f}' AS format, event_type, count(*) AS records, max(event_id) AS last_id FROM events GROUP BY event_type" for f in ("csv", "json", "parquet")
    ),
)
def _(t):
    parts = []
    for fmt in ("csv", "json", "parquet"):
        path = written(t, fmt)
        df = readers.read_any(t.spark, path) if fmt != "json" else readers.read_json(t.spark, path, READING, lines=True)
        parts.append(
            df.groupBy("event_type")
            .agg(F.count("*").alias("records"), F.max("event_id").alias("last_id"))
            .select(F.lit(fmt).alias("format"), "event_type", "records", "last_id")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


FILES = {"click": "Walking_log", "view": "HR_export", "purchase": "bedtime", "signup": "resting", "error": "notes"}
TYPES = {"click": "steps", "view": "heart_rate", "purchase": "sleep", "signup": "sleep", "error": "unknown"}


def folder(t) -> str:
    name = columns.literal_map(FILES)[F.col("event_type")]
    path = scratch_path(t.spark, "folder")
    readings(t).withColumn("source", name).write.partitionBy("source").parquet(path)
    return path


ROUTE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPES.items()) + " END"
FILE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN 'source={v}'" for k, v in FILES.items()) + " END"


@query("s7_route_files", f"SELECT event_id, {R('value')} AS value, {ROUTE} AS data_type FROM events")
def _(t):
    return readers.load_folder(t.spark, folder(t)).select("event_id", "value", "data_type")


@query(
    "s8_schema_check",
    """
    SELECT 'heart_rate' AS data_type, true AS valid, '' AS missing, count(*) AS rows FROM events
    UNION ALL SELECT 'sleep', false, 'duration_minutes', count(*) FROM events
    UNION ALL SELECT 'steps', true, '', count(*) FROM events
    UNION ALL SELECT 'unknown', true, '', count(*) FROM events
    """,
)
def _(t):
    df = t.events.select(
        F.col("ts").alias("Timestamp (UTC)"),
        F.col("ts").cast("date").alias("Date"),
        F.col("value").alias("Avg Heart-Rate"),
        F.col("event_id").alias("Step Count"),
    )
    checks = F.array(
        *[
            F.struct(
                F.lit(kind).alias("data_type"),
                F.lit(columns.has_schema(df, kind)).alias("valid"),
                F.lit(", ".join(columns.missing_columns(df.columns, kind))).alias("missing"),
            )
            for kind in ("heart_rate", "sleep", "steps", "unknown")
        ]
    )
    return df.agg(F.count("*").alias("rows")).select(F.inline(checks), "rows")


@query(
    "s9_load_metadata",
    f"SELECT {FILE} AS file_name, {ROUTE} AS data_type, count(*) AS rows, 6::bigint AS columns FROM events GROUP BY ALL",
)
def _(t):
    return readers.load_metadata(readers.load_folder(t.spark, folder(t))).drop("loaded_at")


@query(
    "s10_empty_input",
    """
    SELECT 'events' AS source, true AS accepted, count(*) AS rows FROM events
    UNION ALL SELECT 'nothing', false, count(*) FROM events WHERE value < 0
    """,
)
def _(t):
    nothing = readings(t).filter("value < 0")
    parts = []
    for name, df in (("events", readings(t)), ("nothing", nothing)):
        path = written(t, "parquet", df=df)
        try:
            readers.read_any(t.spark, path)
            accepted = True
        except ValueError:
            accepted = False
        read = readers.read_any(t.spark, path, allow_empty=True)
        parts.append(read.agg(F.lit(name).alias("source"), F.lit(accepted).alias("accepted"), F.count("*").alias("rows")))
    return parts[0].unionByName(parts[1])


@query("k1_write_processed", f"SELECT event_id, {R('value')} AS value, {ROUTE} AS data_type FROM events")
def _(t):
    kind = columns.literal_map(TYPES)[F.col("event_type")]
    df = t.events.select("event_id", "value", kind.alias("data_type"))
    path = writers.write_processed(df, scratch_path(t.spark, "processed"))
    return t.spark.read.option("header", True).schema("event_id long, value double, data_type string").csv(path)


@query("k2_convert_formats", ROWS)
def _(t):
    first = written(t, "parquet")
    second = writers.convert(t.spark, first, scratch_path(t.spark, "converted") + ".json", "json")
    return readers.read_json(t.spark, second, READING, lines=True)


@query(
    "k3_export_report",
    f"""
    WITH r AS (SELECT event_type, count(*) AS total, count(*) FILTER (high OR low) AS found FROM ({SUSTAINED}) GROUP BY event_type)
    SELECT 'txt' AS format, 'event_type: ' || event_type AS line FROM r
    UNION ALL SELECT 'txt', 'counts: {{"total":' || total || ',"found":' || found || '}}' FROM r
    UNION ALL SELECT 'csv', event_type || ',' || total || ',' || found FROM r
    UNION ALL SELECT 'json', '{{"event_type":"' || event_type || '","counts":{{"total":' || total || ',"found":' || found || '}}}}' FROM r
    """,
)
def _(t):
    counts = sustained(t).groupBy("event_type").agg(
        F.struct(F.count("*").alias("total"), F.count_if("threshold_anomaly").alias("found")).alias("counts")
    )
    parts = []
    for fmt in ("txt", "csv", "json"):
        path = writers.export_report(counts, scratch_path(t.spark, "report"), fmt)
        if fmt == "csv":
            read = t.spark.read.option("header", True).csv(path).select(
                F.concat_ws(",", "event_type", "counts_total", "counts_found").alias("value")
            )
        else:
            read = t.spark.read.text(path)
        parts.append(read.select(F.lit(fmt).alias("format"), F.col("value").alias("line")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "k4_anomaly_report_json",
    f"""
    SELECT '{{"user_id":' || user_id || ',"method":"Threshold-Based","total_records":' || count(*) || ',"anomalies_detected":'
           || count(*) FILTER (high OR low) || '}}' AS report FROM ({SUSTAINED}) GROUP BY user_id
    """,
)
def _(t):
    report = anomaly.threshold_report(sustained(t), ["user_id"], "heart_rate")
    return writers.anomaly_report_json(report.select("user_id", "method", "total_records", "anomalies_detected"))


@query(
    "k5_export_anomalies",
    f"""
    SELECT event_id, 'heart_rate' AS data_type, severity, NULL::double AS duration_minutes FROM ({SUSTAINED}) WHERE high OR low
    UNION ALL SELECT event_id, 'sleep', severity, {R('duration_minutes')} FROM ({INSTANT}) WHERE threshold_anomaly
    """,
)
def _(t):
    path = writers.export_anomalies({"heart_rate": sustained(t), "sleep": instant(t)}, scratch_path(t.spark, "anomalies"), "parquet")
    return t.spark.read.parquet(path).select("event_id", "data_type", "severity", "duration_minutes")
