"""Raw observation files as DataFrames with the product's declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import observed_at, path_columns
from ..model import OBSERVED, STATION, product_schema, quality_column

# Properties of the raw files.
CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "encoding": "ISO-8859-1",
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def with_time(df: DataFrame) -> DataFrame:
    """Observation hour as a timestamp; NULL where the text does not parse."""
    return df.withColumn("timestamp", observed_at(OBSERVED))


def read_observations(
    spark: SparkSession, path: str | list[str], product: str, pattern: str = "*.txt"
) -> DataFrame:
    """A file, or all files below a folder at any depth.

    A trailing end-of-record column is dropped by position; cells that do not
    parse become NULL.  Files are split by Spark; nothing is counted here.
    """
    schema = product_schema(product)
    paths = [path] if isinstance(path, str) else list(path)
    df = (
        spark.read.options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .schema(schema)
        .csv(paths)
    )
    return with_time(
        df.select(
            *schema.names,
            F.col("_metadata.file_path").alias("_source_file"),
            F.lit(",".join(paths)).alias("_source_prefix"),
            F.current_timestamp().alias("_parsed_at"),
        )
    )


def stream_observations(
    spark: SparkSession, path: str, product: str, pattern: str = "*.txt"
) -> DataFrame:
    """The same files as a stream: each file is read once over all runs."""
    schema = product_schema(product)
    df = (
        spark.readStream.options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .schema(schema)
        .csv(path)
    )
    return with_time(df.select(*schema.names, F.col("_metadata.file_path").alias("_source_file")))


def parse_lines(lines: DataFrame, product: str, *kept: str) -> DataFrame:
    """Rows from text lines (column value); header and blank lines are skipped."""
    schema = product_schema(product)
    body = lines.where((F.trim("value") != "") & ~F.trim("value").startswith(STATION))
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "encoding")}
    # from_csv wants as many columns as a line has; the end-of-record one goes.
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("value", f"{ddl}, eor string", options)
    # Unfolded as a table of one row: a plain column would be parsed again for each
    # mention of a cell, and for each filter that Spark pushes below it.
    return with_time(body.select(*kept, F.inline(F.array(row))).select(*kept, *schema.names))


# ------------------------------------------------------- columns by their names

END = "eor"


def _cells(line: str) -> Column:
    return F.transform(F.split(line, ";", -1), lambda x: F.trim(x))


def _is_header(line: str) -> Column:
    return F.trim(line).startswith(STATION)


def _headers(lines: DataFrame) -> DataFrame:
    """Column names of each file (file, names); the end-of-record one is left out."""
    names = F.filter(_cells("value"), lambda x: (x != END) & (x != ""))
    found = lines.where(_is_header("value")).select("file", names.alias("names"))
    return found.groupBy("file").agg(F.min("names").alias("names"), F.max("names").alias("_other"))


def header_mismatches(lines: DataFrame, product: str) -> DataFrame:
    """Columns that files (lines: file, value) name unlike the product: file, position from 1, expected, found.

    Reading by position puts such columns under wrong names.  A column that is
    absent or too many has NULL on one side; a file without a header is not listed.
    """
    want = F.array(*[F.lit(n) for n in product_schema(product).names])
    pairs = F.arrays_zip(want.alias("expected"), F.col("names").alias("found"))
    each = _headers(lines).select("file", F.posexplode(pairs).alias("at", "pair"))
    rows = each.select("file", (F.col("at") + 1).alias("position"), "pair.expected", "pair.found")
    return rows.where(~F.col("expected").eqNullSafe(F.col("found")))


def parse_named_lines(lines: DataFrame, product: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """Rows from lines (file, value), each column found by the name its file's header gives it.

    Every quality flag (QN_ and a number) is the product's own; ``aliases`` maps
    further names of files to the product's.  A column no header names is NULL,
    a file without a header is read by position, and one with two different
    headers is an error.  Headers are one short row per file.
    """
    schema = product_schema(product)
    known = {k: v for k, v in (aliases or {}).items()}
    unknown = sorted(set(known.values()) - set(schema.names))
    if unknown:
        raise ValueError(f"{product} has no columns {unknown}")

    def own(name: Column) -> Column:
        made = F.when(name.rlike(r"^QN_[0-9]+$"), quality_column(product))
        for other, ours in known.items():
            made = made.when(name == other, ours)
        return made.otherwise(name)

    differ = ~F.col("names").eqNullSafe(F.col("_other"))
    message = F.concat(F.lit("several headers in "), F.col("file"))
    names = F.when(differ, F.raise_error(message)).otherwise(F.transform("names", own))
    heads = _headers(lines).select("file", names.alias("_names"))
    body = lines.where((F.trim("value") != "") & ~_is_header("value")).select("file", "value")
    default = F.array(*[F.lit(n) for n in schema.names])
    rows = body.join(heads, "file", "left").select(
        "file", _cells("value").alias("_cells"), F.coalesce("_names", default).alias("_names")
    )

    def column(f: T.StructField) -> Column:
        at = F.array_position("_names", f.name).cast("int") - 1
        return F.nullif(F.get("_cells", at), F.lit("")).try_cast(f.dataType).alias(f.name)

    return with_time(rows.select("file", *[column(f) for f in schema.fields]))


def read_text(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """Plain lines with their file, for format checks."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )


def read_named(
    spark: SparkSession, path: str, product: str, pattern: str = "*.txt", aliases: dict[str, str] | None = None
) -> DataFrame:
    """Files whose columns are found by the names of their headers, see ``parse_named_lines``."""
    rows = parse_named_lines(read_text(spark, path, pattern), product, aliases)
    return rows.withColumnRenamed("file", "_source_file").withColumns(
        {"_source_prefix": F.lit(path), "_parsed_at": F.current_timestamp()}
    )


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder with the variable, station and year of their path."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    return path_columns(files, "path")
