"""Writing processed tables, converting formats, exporting reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.operators.anomaly import anomalous_rows
from vitalgrid.sources.readers import read_any

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_processed(df: DataFrame, path: str, by: str = "data_type", fmt: str = "csv") -> str:
    """One folder per data type."""
    writer = df.write.mode("error").partitionBy(by).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str) -> str:
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"unsupported output format {fmt}")
    writer = df.write.mode("error").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt in ("csv", "json"):
        writer = writer.option("timestampFormat", ISO).option("timestampNTZFormat", ISO)
    writer.save(path)
    return path


def convert(spark: SparkSession, source: str, target: str, fmt: str, source_format: str = "auto") -> str:
    return write_table(read_any(spark, source, source_format), target, fmt)


def flatten_report(df: DataFrame) -> DataFrame:
    """Nested keys become ``key_subkey``; other nested values become JSON text."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            for sub in f.dataType.fields:
                columns.append(_plain(F.col(f.name)[sub.name], sub.dataType).alias(f"{f.name}_{sub.name}"))
        else:
            columns.append(_plain(F.col(f.name), f.dataType).alias(f.name))
    return df.select(*columns)


def _plain(c, kind: T.DataType):
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else c


def report_lines(df: DataFrame) -> DataFrame:
    """``key: value`` lines, one per field of a report row."""
    lines = [
        F.concat(F.lit(f"{f.name}: "), F.coalesce(_plain(F.col(f.name), f.dataType).cast("string"), F.lit("")))
        for f in df.schema.fields
    ]
    return df.select(F.explode(F.array(*lines)).alias("value"))


def export_report(df: DataFrame, path: str, fmt: str = "json") -> str:
    if fmt == "json":
        df.write.mode("error").json(path)
    elif fmt == "txt":
        report_lines(df).write.mode("error").text(path)
    elif fmt == "csv":
        flatten_report(df).write.mode("error").option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported report format {fmt}")
    return path


def anomaly_report_json(reports: DataFrame) -> DataFrame:
    """One JSON text per report row."""
    return reports.select(F.to_json(F.struct(*reports.columns)).alias("report"))


def export_anomalies(frames: dict[str, DataFrame], path: str, fmt: str = "csv") -> str:
    return write_table(anomalous_rows(frames), path, fmt)
