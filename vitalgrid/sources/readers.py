"""Reading files of mixed formats into tables, by format and by data type."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import FILE_KEYWORDS, JSON_WRAPPERS
from vitalgrid.functions.expressions import nan_to_null
from vitalgrid.operators.columns import flatten, has_schema, parse_timestamp, standardize_columns

# File extensions and their formats; text files hold CSV.
EXTENSIONS = {".csv": "csv", ".txt": "csv", ".json": "json", ".parquet": "parquet"}


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, date_column: str | None = None) -> DataFrame:
    """CSV with a header. Give ``schema`` for large inputs; without one Spark scans the files to
    infer it. ``NaN`` counts as missing. ``date_column`` is parsed to an instant (null where it does not
    parse)."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    df = nan_to_null(df)
    if date_column and date_column in df.columns and not isinstance(df.schema[date_column].dataType, T.TimestampType):
        df = df.withColumn(date_column, parse_timestamp(F.col(date_column)))
    return df


def read_json(
    spark: SparkSession, path, schema: T.StructType | str | None = None, lines: bool = False, nested: str = "flatten"
) -> DataFrame:
    """JSON: a list of records, an object that wraps the list, or a single object; with ``lines``
    one record or wrapper per line, which splits over tasks. A list is never unwrapped: its records may
    have an array under a wrapper's name. Nested objects become dotted columns unless
    ``nested`` is ``keep``."""
    reader = spark.read.option("multiLine", not lines)
    df = reader.schema(schema).json(path) if schema else reader.json(path)
    for wrapper in JSON_WRAPPERS:
        if wrapper in df.columns and isinstance(df.schema[wrapper].dataType, T.ArrayType):
            if not lines and _holds_lists(spark, path):
                break
            df = df.select(F.explode(wrapper).alias("_r")).select("_r.*")
            break
    return flatten(df) if nested == "flatten" else df


def _holds_lists(spark: SparkSession, path) -> bool:
    """Whether any of the files begins with a bracket. Asked only where a wrapper's name turns up."""
    start = spark.read.text(path, wholetext=True).select(F.substring(F.ltrim("value"), 1, 1).alias("c"))
    return not start.filter("c = '['").isEmpty()


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def format_of(path: str) -> str:
    extension = os.path.splitext(path)[1].lower()
    if extension not in EXTENSIONS:
        raise ValueError(f"unsupported file format {extension or path}")
    return EXTENSIONS[extension]


def read_any(spark: SparkSession, path: str, fmt: str = "auto", schema=None, allow_empty: bool = False) -> DataFrame:
    """Read by extension or by an explicit format; empty input is an error."""
    fmt = format_of(path) if fmt == "auto" else EXTENSIONS.get(f".{fmt}", fmt)
    if fmt == "csv":
        df = read_csv(spark, path, schema)
    elif fmt == "json":
        df = read_json(spark, path, schema)
    elif fmt == "parquet":
        df = read_parquet(spark, path)
    else:
        raise ValueError(f"unsupported file format {fmt}")
    if not allow_empty and df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def type_of_name(name: Column) -> Column:
    """The data type that keywords in a file name point to."""
    lowered = F.lower(name)
    kind = F.lit("unknown")
    for data_type, words in reversed(FILE_KEYWORDS.items()):
        kind = F.when(lowered.rlike("|".join(words)), F.lit(data_type)).otherwise(kind)
    return kind


def data_type_of(path: str) -> str:
    name = os.path.basename(path).lower()
    for data_type, words in FILE_KEYWORDS.items():
        if any(w in name for w in words):
            return data_type
    return "unknown"


def load_files(spark: SparkSession, paths: list[str], on_conflict: str = "union") -> dict[str, DataFrame]:
    """Files by data type, in standard column names. Several files of one type are put together,
    or with ``on_conflict='last'`` the last one is kept. Files that miss required columns are left
    out."""
    found: dict[str, list[DataFrame]] = {}
    for path in paths:
        data_type = data_type_of(path)
        df = read_any(spark, path)
        if not has_schema(df, data_type):
            continue
        found.setdefault(data_type, []).append(standardize_columns(df))
    join = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    return {t: (dfs[-1] if on_conflict == "last" else reduce(join, dfs)) for t, dfs in found.items()}


def load_folder(spark: SparkSession, path, fmt: str = "parquet", schema=None) -> DataFrame:
    """One scan over a folder of many files; every row carries ``file_name`` and ``data_type``.
    A file that Spark wrote (``part-…``) goes by the name of its folder."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    path = F.split(F.col("_metadata.file_path"), "/")
    own, folder = F.element_at(path, -1), F.element_at(path, -2)
    name = F.when(own.startswith("part-"), folder).otherwise(own)
    return df.select("*", name.alias("file_name"), type_of_name(name).alias("data_type"))


def load_metadata(df: DataFrame) -> DataFrame:
    """Rows and columns per file of a table read by ``load_folder``."""
    helpers = ("file_name", "data_type")
    return df.groupBy(*helpers).agg(F.count("*").alias("rows")).withColumns(
        {"columns": F.lit(len([c for c in df.columns if c not in helpers])), "loaded_at": F.current_timestamp()}
    )
