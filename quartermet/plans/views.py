"""Weather-shaped views over the given tables.

``lineitem`` gives hourly observations (one row per station and hour),
``supplier`` the stations, ``events`` the request log, ``orders`` dataset
versions and schema registrations.  Every view reads its whole table.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import version_name
from ..layout import Layout
from ..model import (
    CURATED_NAMES,
    OBSERVED,
    OBSERVED_FORMAT,
    PIPELINE,
    PRODUCT_PREFIXES,
    PRODUCT_SCHEMAS,
    STATION,
    Profile,
    quality_column,
)
from ..operators import cleaning
from ..operators.features import features
from ..session import shared_folder
from ..sinks.files import read_listed, write_files
from ..sinks.tables import upsert_features
from ..sources import archives


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------- observations

#: measure -> expression over a line
MEASURES = {
    "QN": "CAST(1 + l_orderkey % 10 AS INT)",
    "TT_TU": "CASE WHEN l_linenumber = 7 THEN -999D WHEN l_orderkey % 97 = 0 "
    "THEN l_quantity + 40 ELSE l_quantity - 25 END",
    "RF_TU": "CASE WHEN l_orderkey % 109 = 0 THEN 104D ELSE round(20 + l_discount * 800, 6) END",
    "R1": "CASE WHEN l_orderkey % 101 = 0 THEN -1D "
    "ELSE round(greatest(l_discount - 0.05D, 0D) * 100, 1) END",
    "RS_IND": "CASE WHEN l_discount > 0.055D THEN 1 ELSE 0 END",
    "WRTR": "l_linenumber",
    "F": "CASE WHEN l_orderkey % 103 = 0 THEN 160D ELSE l_quantity / 4 END",
    "D": "CASE WHEN l_orderkey % 11 = 0 THEN -999 ELSE CAST(l_partkey * 37 % 361 AS INT) END",
    "P": "CASE WHEN l_orderkey % 107 = 0 THEN 800D ELSE l_quantity + 985 END",
    "P0": "l_quantity + 993",
    "TF_TU": "l_quantity - 31.5D",
    "V_N": "CAST(l_linenumber + 1 AS DOUBLE)",
    "V_N_I": "l_returnflag",
    "ATMO_STRAHL": "CAST(floor(l_extendedprice / 800) AS DOUBLE)",
    "FD_STRAHL": "CAST(floor(l_extendedprice / 1000) AS DOUBLE)",
    "FG_STRAHL": "CAST(floor(l_extendedprice / 500) AS DOUBLE)",
}

LINE_HOUR = (
    "l_shipdate + make_dt_interval(0, CAST(l_linenumber - 1 + 7 * (l_orderkey % 3) AS INT))"
)


#: Stored bytes of a table that one task after a shuffle gets.
TASK_BYTES = 2 * 1024 * 1024

#: Tasks for a table: application, file -> number.
_TASKS: dict[tuple[str, str], int] = {}


def tasks_for(spark: SparkSession, sf_dir: str, name: str) -> int:
    """How many tasks share a table: their number grows with its stored bytes, so that a task's part does not."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TASKS:
        stored = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
        _TASKS[key] = 1 + stored // TASK_BYTES
    return _TASKS[key]


def hourly(spark: SparkSession, sf_dir: str, *measures: str) -> DataFrame:
    """One row per station and hour with the measures asked for.

    Rows are shuffled once, by station: what follows by station and hour, day,
    quarter or year finds its rows in one task and is not shuffled again.
    """
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        f"CAST(l_suppkey AS INT) AS {STATION}",
        f"{LINE_HOUR} AS timestamp",
        *[f"{MEASURES[n]} AS {n}" for n in measures],
    ).repartition(tasks_for(spark, sf_dir, "lineitem"), STATION)
    if not measures:
        return rows.distinct()
    return rows.groupBy(STATION, "timestamp").agg(*[F.max(n).alias(n) for n in measures])


def parsed(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """Rows shaped as the parser returns them for one product."""
    schema = PRODUCT_SCHEMAS[product]
    quality = quality_column(product)
    return (
        hourly(spark, sf_dir, "QN", *schema.names[3:])
        .withColumnRenamed("QN", quality)
        .withColumn(OBSERVED, F.date_format("timestamp", OBSERVED_FORMAT))
        .select(*schema.names, "timestamp")
    )


def cleaned(
    spark: SparkSession, sf_dir: str, product: str, profile: Profile = PIPELINE
) -> DataFrame:
    return cleaning.clean(parsed(spark, sf_dir, product), product, profile)


STAGED_VERSION = "all_staged_v1"


def staged(
    spark: SparkSession, sf_dir: str, product: str, profile: Profile = PIPELINE
) -> DataFrame:
    """Cleaned rows of one product under one staged version."""
    rows = cleaned(spark, sf_dir, product, profile)
    # A value of the row, as in a staged table, not a constant of the plan.
    version = F.when(F.col(STATION).isNotNull(), STAGED_VERSION)
    return rows.withColumn("dataset_version", version)


def curated_version(df: DataFrame) -> DataFrame:
    """Rows under the curated version of their quarter."""
    return df.withColumn("dataset_version", version_name("year", "quarter"))


def product_features(
    spark: SparkSession, sf_dir: str, product: str, profile: Profile = PIPELINE, **options: bool
) -> DataFrame:
    """Features of a product, named by quarter; names are put on the few feature rows."""
    rows = staged(spark, sf_dir, product, profile)
    return curated_version(features(rows, product, profile, **options))


#: Curated tables written by this process: application, input, table -> path and schema.
_STORED: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def curated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Stored feature tables of all five products by curated name."""
    return {n: curated_table(spark, sf_dir, n) for n in CURATED_NAMES.values()}


def curated_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored feature table, partitioned by version, year and quarter and sorted by station.

    The first read of a session computes and writes it, as the curating job does;
    later ones read what is stored.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        product = next(p for p, n in CURATED_NAMES.items() if n == name)
        made = product_features(spark, sf_dir, product)
        path = Layout(shared_folder(spark, "curated")).curated(name)
        upsert_features(made, path)
        _STORED[key] = path, made.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def raw_lines(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """Observations as lines of a raw file, the station as five digits."""
    schema = PRODUCT_SCHEMAS[product]
    cells = [F.lpad(F.col(STATION).cast("string"), 5, "0")]
    cells += [F.col(c).cast("string") for c in schema.names[1:]]
    cells.append(F.lit("eor"))
    return parsed(spark, sf_dir, product).select(
        STATION, "timestamp", F.concat_ws(";", *cells).alias("value")
    )


def header_line(product: str) -> str:
    return ";".join([*PRODUCT_SCHEMAS[product].names, "eor"])


# -------------------------------------------------------------- stations

def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("int")
    active = F.col("s_acctbal") > 0
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey", "left")
        .select(
            key.alias("station_id"),
            F.col("s_name").alias("station_name"),
            (F.lit(47.0) + (key % 800) / 100).alias("latitude"),
            (F.lit(6.0) + (key % 900) / 100).alias("longitude"),
            (key * 13 % 2900).cast("int").alias("elevation_m"),
            "state",
            F.date_add(F.lit("1995-01-01").cast("date"), key % 10 * 100).alias("start_date"),
            F.when(~active, F.lit("2000-12-31").cast("date")).alias("end_date"),
            active.alias("is_active"),
        )
    )


# ----------------------------------------------------------- request log

def request_columns() -> list[Column]:
    """Request log columns from an ``events`` row, batch or stream."""
    kind, value = F.col("event_type"), F.col("value")
    endpoint = F.element_at(
        F.array(
            F.lit("/stations"),
            F.lit("/features/temperature"),
            F.lit("/features/wind"),
            F.lit("/features/products"),
            F.lit("/health"),
        ),
        (F.col("user_id") % 5 + 1).cast("int"),
    )
    status = (
        F.when((kind == "error") & (value > 20), 500)
        .when((kind == "click") & (value > 60), 404)
        .when(kind == "signup", 201)
        .otherwise(200)
    )
    return [
        F.col("event_id").alias("request_id"),
        "ts",
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        endpoint.alias("endpoint"),
        status.alias("status"),
        (value / 1000).alias("duration_s"),
        F.col("user_id").alias("caller"),
    ]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*request_columns())


# ------------------------------------------------------------- catalogue

def version_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation (one per order) and status updates (one per line) of versions."""
    created = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("version_id"),
        F.concat(F.lit("dataset_"), F.col("o_custkey").cast("string")).alias("dataset_name"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"),
        F.col("o_orderdate").alias("at"),
        F.lit(0).cast("bigint").alias("step"),
        F.lit("pending").alias("status"),
    )
    line = F.col("l_linenumber").cast("bigint")
    updated = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("version_id"),
        F.col("l_shipdate").alias("at"),
        (line * 10_000_000 + F.col("l_partkey")).alias("step"),
        F.when(F.col("l_linestatus") == "F", "available")
        .when(F.col("l_returnflag") == "R", "failed")
        .otherwise("processing")
        .alias("status"),
        F.when(line % 2 == 0, F.col("l_quantity").cast("bigint")).alias("record_count"),
        F.when(line % 3 == 0, F.col("l_suppkey")).alias("total_size_bytes"),
    )
    return created.unionByName(updated, allowMissingColumns=True)


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent-child pairs of versions, with repeats."""
    kind = F.when(F.col("l_returnflag") == "A", "aggregation").otherwise("filter")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("child_id"),
        F.col("l_partkey").alias("parent_id"),
        kind.alias("transformation_type"),
    )


def schema_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema registrations: one per order, its lines being the fields."""
    # Lines are shuffled once, by order: a task holds few orders however many there are.
    read = ("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    tasks = tasks_for(spark, sf_dir, "lineitem")
    line = table(spark, sf_dir, "lineitem").select(*read).where("l_orderkey IS NOT NULL").repartition(tasks, "l_orderkey")
    field = F.concat(F.lit("f"), (F.col("l_partkey") % 3).cast("string"))
    required = F.max(F.col("l_linestatus") == "O")
    fields = line.groupBy("l_orderkey", field.alias("field")).agg(
        F.struct(
            F.max(F.when(F.col("l_returnflag") == "N", "0")).alias("default"),
            required.alias("required"),
            F.when(F.max(F.col("l_linenumber")) > 4, "double").otherwise("string").alias("type"),
        ).alias("definition")
    )
    # At most three fields per order: the map is bounded.
    maps = fields.groupBy("l_orderkey").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("field"), F.col("definition"))))
        ).alias("fields")
    )
    mode = F.element_at(
        F.array(*[F.lit(m) for m in ("BACKWARD", "FORWARD", "FULL", "NONE")]),
        (F.col("o_orderkey") % 4 + 1).cast("int"),
    )
    name = F.concat(F.lit("schema_"), F.floor(F.col("o_custkey") / 10).cast("string"))
    return (
        table(spark, sf_dir, "orders")
        .repartition(tasks, "o_orderkey")
        .join(maps, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_orderkey").alias("request_id"),
            name.alias("schema_name"),
            "fields",
            F.col("o_orderpriority").alias("description"),
            mode.alias("compatibility_mode"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderstatus").alias("created_by"),
        )
    )


# --------------------------------------------------------------- listings

def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory pages: the given web pages, and one page per product and station.

    A station page holds a line per year, so it is bounded by the years covered.
    """
    years = (
        hourly(spark, sf_dir).select(STATION, F.year("timestamp").alias("year")).distinct()
    )
    prefixes = F.create_map(*[F.lit(x) for pair in PRODUCT_PREFIXES.items() for x in pair])
    file = F.format_string(
        "%s%05d_%d0101_%d1231_hist.zip", F.col("prefix"), F.col(STATION), F.col("year"), F.col("year")
    )
    line = F.concat(F.lit('<a href="'), file, F.lit('">'), file, F.lit("</a> 2024-01-01 120K"))
    derived = (
        years.select(STATION, "year", F.explode(prefixes).alias("variable", "prefix"))
        .groupBy("variable", STATION)
        .agg(
            F.concat_ws(
                "\n", F.lit("<html><pre>"), F.array_sort(F.collect_list(line)), F.lit("</pre></html>")
            ).alias("html")
        )
        .select(F.concat_ws("-", "variable", STATION).alias("page"), "html")
    )
    given = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("page"), "html")
    return given.unionByName(derived)


# --------------------------------------------------------------- archives

def _zip_text(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """One archive per text, holding it and a metadata file."""
    for batch in texts:
        made = []
        for text in batch:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                # A fixed date: the same text must give the same bytes when a task is repeated.
                for name, content in (("Metadaten_Parameter.txt", "Parameter\n"), ("produkt.txt", text)):
                    member = zipfile.ZipInfo(name, date_time=(2024, 1, 1, 0, 0, 0))
                    archive.writestr(member, content, zipfile.ZIP_DEFLATED)
            made.append(buffer.getvalue())
        yield pd.Series(made)


def archive_files(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """An archive per station and year (path, content, rows).

    Rows are unique per station and hour, so an archive holds at most 8,784 lines.
    """
    zipped = F.pandas_udf(_zip_text, "binary")
    lines = raw_lines(spark, sf_dir, product).groupBy(STATION, F.year("timestamp").alias("year")).agg(
        F.array_sort(F.collect_list("value")).alias("lines"), F.count(F.lit(1)).alias("rows")
    )
    text = F.concat(F.lit(header_line(product) + "\n"), F.array_join("lines", "\n"), F.lit("\n"))
    return lines.select(
        F.format_string("station_%05d/%d.zip", F.col(STATION), F.col("year")).alias("path"),
        zipped(text).alias("content"),
        "rows",
    )


#: Archives unpacked by this process: application, input, product -> folder.
_UNPACKED: dict[tuple[str, str, str], str] = {}


def unpacked_archives(spark: SparkSession, sf_dir: str, product: str) -> tuple[DataFrame, DataFrame]:
    """The archives of a product, stored as zip files and unpacked in one pass, and their side files.

    Side files are right where an archive has an even number of rows.  The first
    read of a session writes the files; later ones read what is stored.
    """
    key = (spark.sparkContext.applicationId, sf_dir, product)
    if key not in _UNPACKED:
        folder = shared_folder(spark, "archives")
        right = F.when(F.col("rows") % 2 == 0, F.sha2("content", 256)).otherwise(F.md5("content"))
        side = F.concat(F.rpad(right, 64, "0"), F.lit("  "), F.col("path")).cast("binary")
        pair = F.array(
            F.struct("path", "content"),
            F.struct(F.concat("path", F.lit(".sha256")).alias("path"), side.alias("content")),
        )
        made = archive_files(spark, sf_dir, product).select(F.inline(pair))
        write_files(made, f"{folder}/files", f"{folder}/listed")
        files = read_listed(spark.read.parquet(f"{folder}/listed"), f"{folder}/files", ".zip")
        archives.unpack_archives(files, f"{folder}/unpacked")
        _UNPACKED[key] = folder
    folder = _UNPACKED[key]
    unpacked = spark.read.schema(archives.UNPACKED).parquet(f"{folder}/unpacked")
    return unpacked, read_listed(spark.read.parquet(f"{folder}/listed"), f"{folder}/files", ".sha256")
