"""Landing files to raw zone to bronze table, with idempotent re-runs.

All pending files are one scan and one write per zone. Nothing is shuffled: a scan task
holds splits of source files and writes them under the partition of each source, so a
file that makes up most of a delivery is written by as many tasks as it has splits.

A table is a set of versions (see ``versions``): a run appends its rows and then replaces one view, the
ledger, by which readers go from the old rows of all its sources to the new ones at once. The ledger
names the sources that landed, with their row counts. A run that dies before that point has changed
nothing and is repeated in full by the next one, which removes what it left.

Types are settled once for a run, over all its files, and against the table: a column widens
(integers to double where that is exact, anything else that differs to text), it never narrows. How
many files are committed together has no influence on the result.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.headers import coerce_text, normalise_columns, normalise_name
from gridlake.operators.relational import pending_sources
from gridlake.plans.versions import VersionedTable, folder_of, literal, quoted, wider_type  # noqa: F401
from gridlake.session import remove_path
from gridlake.sources.files import SOURCE_COLUMN, discover_files, literal_path, read_market_csv

FOLDER_COLUMN = "_folder"

# Files that one scan and one commit take together.
FILES_PER_COMMIT = 10_000


@dataclass(frozen=True)
class Target:
    """Where a folder lands: raw zone path, table, and table location and format."""

    raw_path: str
    database: str = "bronze"
    table: str | None = None
    location: str | None = None
    table_format: str = "parquet"

    def full_name(self, folder: str) -> str:
        return f"{quoted(self.database)}.{quoted(self.table or table_name(folder))}"

    def ledger_name(self, folder: str) -> str:
        return f"{quoted(self.database)}.{quoted((self.table or table_name(folder)) + '__landed')}"


def table_name(folder: str) -> str:
    """A folder name as a table name: normalised, all but letters and digits as underscores."""
    return re.sub(r"[^0-9a-z]", "_", normalise_name(folder).lower())


def clean(df: DataFrame) -> DataFrame:
    """Normalised headers and table-ready types; the provenance tag keeps its name."""
    return coerce_text(normalise_columns(df))


def audit(df: DataFrame, source: str = SOURCE_COLUMN) -> DataFrame:
    """Rows and non-null counts of every column, per source."""
    counts = [F.count(F.col(f"`{c}`")).alias(f"{c}_present") for c in df.columns if c != source]
    return df.groupBy(source).agg(F.count("*").alias("rows"), *counts)


def ledger(spark: SparkSession, name: str) -> DataFrame:
    """Sources that landed, one row each."""
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], f"{SOURCE_COLUMN} STRING")
    return spark.table(name).select(SOURCE_COLUMN).distinct()


def versioned(spark: SparkSession, target: Target, folder: str) -> VersionedTable:
    table = target.table or table_name(folder)
    place = f"{target.location}/{table_name(folder)}" if target.location else None
    return VersionedTable(spark, target.database, table, place, target.table_format)


def write_raw(batch: DataFrame, raw_path: str, folder: str) -> None:
    """Replace the raw copies of the batch's sources and leave all others alone."""
    (
        batch.withColumn(FOLDER_COLUMN, F.lit(folder))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(FOLDER_COLUMN, SOURCE_COLUMN)
        .parquet(raw_path)
    )


def raw_folder(spark: SparkSession, raw_path: str, folder: str, source: str) -> str:
    """Where the raw zone keeps a source: Spark's own escaping of partition values."""
    return f"{raw_path}/{folder_of(spark, FOLDER_COLUMN, folder)}/{folder_of(spark, SOURCE_COLUMN, source)}"


def read_raw(spark: SparkSession, raw_path: str, folder: str, schema: T.StructType, sources: list[str]) -> DataFrame:
    """Raw copies of some sources of a folder; only their own folders are listed.

    The schema is given, so partition values stay text whatever they look like."""
    zone = T.StructType([f for f in schema.fields if f.name != SOURCE_COLUMN])
    zone = zone.add(FOLDER_COLUMN, T.StringType()).add(SOURCE_COLUMN, T.StringType())
    if not sources:
        return spark.createDataFrame([], zone).drop(FOLDER_COLUMN)
    paths = [literal_path(raw_folder(spark, raw_path, folder, s)) for s in sources]
    return spark.read.option("basePath", raw_path).schema(zone).parquet(*paths).drop(FOLDER_COLUMN)


def replace_sources(batch: DataFrame | None, delivered: DataFrame, target: Target, folder: str, run: str | None = None) -> None:
    """Let the rows of each delivered source take the place of its earlier ones. ``delivered`` has
    (source, rows); a source without rows loses those it had. ``batch`` is None if no source has any.

    Built-in tables switch all sources in one statement. An Iceberg table takes one atomic
    ``overwritePartitions`` commit, then the deletes, then the ledger."""
    spark = delivered.sparkSession
    if target.table_format != "iceberg":
        versioned(spark, target, folder).publish(batch, delivered, run)
        return
    table, name = target.full_name(folder), target.ledger_name(folder)
    if batch is not None:
        if spark.catalog.tableExists(table):
            batch.writeTo(table).option("mergeSchema", "true").overwritePartitions()
        else:
            batch.writeTo(table).using("iceberg").partitionedBy(F.col(SOURCE_COLUMN)).create()
    empty = [r[0] for r in delivered.where("rows = 0").select(SOURCE_COLUMN).collect()]  # names only
    if empty and spark.catalog.tableExists(table):
        spark.sql(f"DELETE FROM {table} WHERE {quoted(SOURCE_COLUMN)} IN ({', '.join(map(literal, empty))})")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({SOURCE_COLUMN} STRING, rows BIGINT, run STRING) USING iceberg")
    delivered.select(SOURCE_COLUMN, "rows", F.lit(run or uuid.uuid4().hex).alias("run")).writeTo(name).append()


def create_database(spark: SparkSession, target: Target) -> None:
    place = f" LOCATION {literal(target.location)}" if target.location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(target.database)}{place}")


def _land(spark: SparkSession, files: list, folder: str, target: Target, sep: str, schema, run: str) -> None:
    """One commit: scan, clean, raw write, bronze replace, ledger."""
    sources = [f[SOURCE_COLUMN] for f in files]
    cleaned = clean(read_market_csv(spark, [literal_path(f.path) for f in files], sep, schema, tag_source=True))
    seen = Observation("filled sources")
    write_raw(cleaned.observe(seen, F.collect_set(SOURCE_COLUMN).alias("sources")), target.raw_path, folder)
    filled = set(seen.get["sources"])
    empty = [s for s in sources if s not in filled]
    # A delivery without rows replaces nothing by itself: its old rows go from both zones.
    for source in empty:
        remove_path(spark, raw_folder(spark, target.raw_path, folder, source))
    # From here the cleaned Parquet copy is the input: the delimited text is parsed once.
    batch = read_raw(spark, target.raw_path, folder, cleaned.schema, sorted(filled))
    replace_sources(batch if filled else None, row_counts(spark, sources, batch), target, folder, run)


def row_counts(spark: SparkSession, sources: list[str], batch: DataFrame) -> DataFrame:
    """(source, rows) of every source, 0 for one without rows."""
    found = batch.groupBy(SOURCE_COLUMN).agg(F.count("*").alias("rows"))
    every = spark.createDataFrame([(s,) for s in sources], f"{SOURCE_COLUMN} STRING").join(found, SOURCE_COLUMN, "left")
    return every.select(SOURCE_COLUMN, F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def ingest_folder(
    spark: SparkSession,
    landing: str,
    folder: str,
    target: Target,
    force: bool = False,
    sep: str = ";",
    schema: str | T.StructType | None = None,
    pattern: str = "*.csv",
    files_per_commit: int = FILES_PER_COMMIT,
) -> DataFrame:
    """Land every pending file of a folder and return the sources handled.

    ``landing/folder`` holds the files. Only file names and paths (the scan's own
    listing) pass through the driver. ``force`` reloads landed files too. Without ``schema`` the
    types are inferred once, over all pending files, before any of them is committed."""
    create_database(spark, target)
    if target.table_format != "iceberg":
        versioned(spark, target, folder).repair()
    found = discover_files(spark, f"{landing}/{folder}", pattern).withColumnRenamed("file_name", SOURCE_COLUMN)
    landed = ledger(spark, target.ledger_name(folder))
    files = pending_sources(found, landed, SOURCE_COLUMN, force).orderBy(SOURCE_COLUMN).collect()
    if schema is None and files:
        schema = read_market_csv(spark, [literal_path(f.path) for f in files], sep).schema
    run = uuid.uuid4().hex
    for start in range(0, len(files), files_per_commit):
        _land(spark, files[start : start + files_per_commit], folder, target, sep, schema, run)
    return spark.createDataFrame([(f[SOURCE_COLUMN],) for f in files], f"{SOURCE_COLUMN} STRING")
