"""A folder of files of several formats and data types, read in one scan per format.

Every file gets a status row: nothing is left out in silence. Rows come back in one table with the
columns that the catalog knows, whatever each file calls them. The folder holds files, or folders that
Spark wrote (``name.csv/part-…``), which count as one file under their own name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.catalog import COLUMN_NAMES, JSON_WRAPPERS, NUMBERS, SCHEMAS, TEXTS
from vitalgrid.operators.columns import literal_map, standard_name
from vitalgrid.plans.series import attach
from vitalgrid.session import stored
from vitalgrid.sources.readers import type_of_name

# File extensions and how they are read. ``json`` is one value a file, ``lines`` one a line.
EXTENSIONS = {".csv": "csv", ".txt": "csv", ".json": "json", ".jsonl": "lines", ".ndjson": "lines", ".parquet": "parquet"}

REQUIRED = list(dict.fromkeys(r for schema in SCHEMAS.values() for r in schema["required"]))


@dataclass
class Loaded:
    """``records``: source, data_type, timestamp, keys, the catalog's columns, ``present`` (bits of the columns
    that the source has, in the order of ``NUMBERS``), and block and line, which give the order of a source's
    rows. ``status``: one row per source."""

    records: DataFrame
    status: DataFrame


def load(spark: SparkSession, folder: str, keys: list[str]) -> Loaded:
    """Read all files of ``folder``. ``keys`` are standard column names that identify a series; a source
    without such a column has null there.

    The data type follows from the source's name. Columns are matched by standard name, of several
    with one name the first counts; cells that do not parse are null and counted. A record that cannot be
    read at all is counted as rescued. Sources that cannot be read, have no rows, miss a required column or
    have another format do not get into ``records``; their status says why. CSV records may not span lines.
    Parquet files must agree on the types of their columns.
    """
    files = _listing(spark, folder)
    found = {r["extension"] for r in files.select("extension").distinct().collect()}  # few
    parts = []
    for how, scan in {"csv": _csv, "json": _documents, "lines": _lines, "parquet": _parquet}.items():
        paths = [f"{folder}/*{e}" for e in sorted(found) if EXTENSIONS.get(e.lower()) == how]
        if paths:
            parts.append(scan(spark, paths, keys))
    if not parts:
        nothing = "array() as _names, array() as _values, '' as source, 0L as block, 0L as line, '' as raw"
        parts = [_shaped(spark.sql(f"SELECT {nothing} WHERE false").withColumns({c: F.col(c).cast("array<string>") for c in ("_names", "_values")}), keys)]
    records = stored(reduce(DataFrame.unionByName, parts), "collection")
    status = stored(_status(files, records), "collection-status")
    good = status.filter("success").select("source", "data_type", F.col("_bits").alias("present"))
    joined = attach(records.filter("rescued is null").drop("bits", "rescued", "unparsed"), good, ["source"])
    joined = joined.filter("data_type is not null")
    return Loaded(joined, status.drop("_bits"))


def column_bit(name: str) -> int:
    return 1 << NUMBERS.index(name)


# files -----------------------------------------------------------------------------------------------


def _source(path: Column) -> Column:
    """The file, or the folder of a part that Spark wrote."""
    own = F.element_at(F.split(path, "/"), -1)
    return F.when(own.startswith("part-"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(path)


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per source: name, extension, data type, bytes. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    files = files.select(_source(F.col("_metadata.file_path")).alias("source"), F.col("_metadata.file_size").alias("_size"))
    name = F.element_at(F.split("source", "/"), -1)
    return files.groupBy("source").agg(F.sum("_size").alias("bytes")).select(
        "source",
        name.alias("file_name"),
        F.regexp_extract(name, r"(\.[^.]*)$", 1).alias("extension"),
        type_of_name(name).alias("data_type"),
        "bytes",
    )


def _status(files: DataFrame, records: DataFrame) -> DataFrame:
    counted = records.groupBy("source").agg(
        F.count_if(F.col("rescued").isNull()).alias("rows"),
        F.count_if(F.col("rescued").isNotNull()).alias("rescued"),
        F.sum("unparsed").alias("unparsed"),
        F.bit_or("bits").alias("_bits"),
    )
    rows = attach(files, counted, ["source"])
    how = literal_map(EXTENSIONS)[F.lower("extension")]
    seen = F.coalesce("_bits", F.lit(0))
    missing = F.lit(None).cast("array<string>")
    for kind, schema in SCHEMAS.items():
        lacking = [F.when(seen.bitwiseAND(_required_bit(r)) == 0, F.lit(r)) for r in schema["required"]]
        missing = F.when(F.col("data_type") == kind, F.array_compact(F.array(*lacking))).otherwise(missing)
    has_rows = F.coalesce("rows", F.lit(0)) > 0
    error = (
        F.when(how.isNull(), F.format_string("unsupported file format %s", "extension"))
        .when(~has_rows & (F.coalesce("rescued", F.lit(0)) > 0), F.lit("no record can be read"))
        .when(~has_rows, F.lit("no rows can be read"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", ")))
    )
    columns = F.array_compact(F.array(*[F.when(seen.bitwiseAND(column_bit(c)) != 0, F.lit(c)) for c in NUMBERS]))
    return rows.select(
        "source",
        "file_name",
        how.alias("format"),
        "data_type",
        "bytes",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "rescued", "unparsed")],
        columns.alias("metrics"),
        error.isNull().alias("success"),
        error.alias("error"),
        seen.alias("_bits"),
    )


def _required_bit(name: str) -> int:
    return 1 << (len(NUMBERS) + REQUIRED.index(name))


# records ---------------------------------------------------------------------------------------------


_SNAKE = "replace(replace(lower(trim(n)), ' ', '_'), '-', '_')"
_KNOWN = "map(" + ", ".join(f"'{a}', '{b}'" for a, b in COLUMN_NAMES.items()) + ")"


def _named(rows: DataFrame, names: str) -> DataFrame:
    """Add ``_plain`` and ``_standard``: the array of names in lower case and as standard names."""
    rows = rows.withColumn("_plain", F.expr(f"transform({names}, n -> {_SNAKE})"))
    return rows.withColumn("_standard", F.expr(f"transform(_plain, n -> coalesce({_KNOWN}[n], n))"))


def _covers() -> Column:
    """Bits of the catalog's columns that these names stand for, and of the required columns that match
    any of them, even as a part of a name."""
    bits = [f"if(array_contains(_standard, '{c}'), {column_bit(c)}L, 0L)" for c in NUMBERS]
    bits += [f"if(exists(_plain, n -> contains(n, '{r}') or contains('{r}', n)), {_required_bit(r)}L, 0L)" for r in REQUIRED]
    return F.expr(" + ".join(bits))


def _shaped(rows: DataFrame, keys: list[str], covered: bool = False) -> DataFrame:
    """The common columns of rows that hold ``raw`` text and the arrays ``_names`` and ``_values`` (null names: the
    record cannot be read). ``covered`` rows have their bits and standard names already."""
    if not covered:
        rows = _named(rows, "_names")
        rows = rows.withColumn("bits", _covers())
    cell = {c: f"get(_values, array_position(_standard, '{c}') - 1)" for c in ("timestamp", *keys, *TEXTS, *NUMBERS)}
    typed = {"timestamp": f"try_cast({cell['timestamp']} as timestamp)", **{c: f"try_cast({cell[c]} as double)" for c in NUMBERS}}
    unparsed = [f"if(trim({cell[c]}) <> '' and {value} is null, 1, 0)" for c, value in typed.items()]
    return rows.selectExpr(
        "source",
        "block",
        "line",
        *[f"{typed.get(c, text)} as `{c}`" for c, text in cell.items()],
        "coalesce(bits, 0L) as bits",
        "if(_names is null, raw, null) as rescued",
        f"{' + '.join(unparsed)} as unparsed",
    )


def _text(spark: SparkSession, paths: list[str], whole: bool = False) -> DataFrame:
    rows = spark.read.option("wholetext", whole).text(paths)
    return rows.select(
        F.col("_metadata.file_path").alias("path"),
        _source(F.col("_metadata.file_path")).alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("raw"),
    )


def _csv(spark: SparkSession, paths: list[str], keys: list[str]) -> DataFrame:
    """Lines under the header of their own file: the first line, and every line equal to it. The number of the first
    line comes first: an aggregate that carries texts would sort all lines of a file's first block in one task."""
    lines = _text(spark, paths).filter(F.trim("raw") != "")
    first = lines.filter("block = 0").groupBy("path").agg(F.min("line").alias("line"))
    heads = lines.join(F.broadcast(first), ["path", "line"]).select("path", F.col("raw").alias("head"))
    heads = stored(heads, "collection-heads")
    commas = heads.agg(F.max(F.length("head") - F.length(F.replace("head", F.lit(","), F.lit(""))))).first()[0]
    fields = [f"c{i}" for i in range((commas or 0) + 1)]
    options = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}

    def cells(text: Column) -> Column:
        parsed = F.from_csv(text, ", ".join(f"{f} string" for f in fields), options)
        return F.array(*[parsed[f] for f in fields])

    heads = heads.withColumn("_names", F.filter(cells(F.regexp_replace("head", "^﻿", "")), lambda n: n.isNotNull()))
    heads = _named(heads, "_names").withColumn("bits", _covers()).drop("_plain")
    rows = attach(lines, heads, ["path"]).filter(F.col("raw") != F.col("head"))
    return _shaped(rows.withColumn("_values", cells(F.col("raw"))), keys, covered=True)


def _entries(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Records as maps of text in ``fields``."""
    return _shaped(rows.withColumns({"_names": F.map_keys("fields"), "_values": F.map_values("fields")}), keys)


def _lines(spark: SparkSession, paths: list[str], keys: list[str]) -> DataFrame:
    lines = _text(spark, paths).filter(F.trim("raw") != "")
    return _entries(lines.withColumn("fields", F.from_json("raw", "map<string,string>")), keys)


def _documents(spark: SparkSession, paths: list[str], keys: list[str]) -> DataFrame:
    """One JSON value a file: a list of records, an object that wraps a list, or a single record."""
    files = _text(spark, paths, whole=True)
    records = "array<map<string,string>>"
    outer = F.from_json("raw", "map<string,string>")
    files = files.withColumns({"_list": F.ltrim("raw").startswith("["), "_outer": outer})
    found = F.array(F.col("_outer"))
    for wrapper in reversed(JSON_WRAPPERS):
        inner = F.col("_outer")[wrapper]
        found = F.when(F.ltrim(inner).startswith("["), F.from_json(inner, records)).otherwise(found)
    found = F.when(F.col("_list"), F.from_json("raw", records)).otherwise(found)
    unread = F.array(F.lit(None).cast("map<string,string>"))
    each = files.select("path", "source", "block", "raw", F.posexplode(F.coalesce(found, unread)).alias("line", "fields"))
    return _entries(each.withColumn("line", F.col("line").cast("long")), keys)


def _parquet(spark: SparkSession, paths: list[str], keys: list[str]) -> DataFrame:
    """Typed columns; a column counts as present in a source that has a value in it. A file that is not
    Parquet has no rows."""
    rows = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(*paths)
    by_name: dict[str, list[T.StructField]] = {}
    for field in rows.schema.fields:
        by_name.setdefault(standard_name(field.name), []).append(field)

    def cell(name: str) -> str:
        return "coalesce(" + ", ".join(["cast(null as string)", *[f"cast(`{f.name}` as string)" for f in by_name.get(name, [])]]) + ")"

    wanted = ["timestamp", *keys, *TEXTS, *NUMBERS]
    raw = [f.name for name in wanted for f in by_name.get(name, [])]
    have = ", ".join(f"if(`{n}` is not null, '{n}', null)" for n in raw) or "cast(null as string)"
    places = [_source(F.col("_metadata.file_path")).alias("source"), F.col("_metadata.row_index").alias("line")]
    rows = rows.select(*places, F.expr(f"array_compact(array({have}))").alias("_have"), F.expr(f"array({', '.join(map(cell, wanted))})").alias("_values"))
    rows = _named(rows, "_have").withColumn("bits", _covers())
    names = ", ".join(f"'{c}'" for c in wanted)
    rows = rows.withColumns({"_names": F.expr(f"array({names})"), "_standard": F.expr(f"array({names})"), "block": F.lit(0).cast("long"), "raw": F.lit("")})
    return _shaped(rows, keys, covered=True)
