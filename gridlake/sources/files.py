"""Delimited files, listings and file formats."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_COLUMN = "_source_file"

LISTING_SCHEMA = "page INT, contentItemList ARRAY<STRUCT<name: STRING>>"


def discover_files(spark: SparkSession, folder: str, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """``(file_name, path)`` of the matching files. Only the listing is touched: the file
    source is asked for its paths alone, so no file is opened, and names stay rows of a frame."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")


def literal_path(path: str) -> str:
    """A listed path as reader input: characters that would act as a glob are escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def plain_name(encoded: Column) -> Column:
    """A percent-encoded file name as text. A literal plus sign is protected, because
    decoding would read it as a space."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def source_name() -> Column:
    """Plain name of the file a row comes from (the metadata column holds it encoded)."""
    return plain_name(F.col("_metadata.file_name"))


def prefer_local(local: DataFrame, remote: DataFrame) -> DataFrame:
    """The local listing whenever it has any file at all, else the remote one."""
    return remote if local.isEmpty() else local


def read_market_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    schema: str | T.StructType | None = None,
    tag_source: bool = False,
    **options: str,
) -> DataFrame:
    """Delimited files with a header row, all in one scan.

    Each file's header is checked against the schema, so a file with other columns fails
    by name instead of being read by position. Without ``schema`` types are inferred,
    which costs one more pass over the files: give the schema for large folders. A value
    that does not fit a given schema fails the read unless ``mode="PERMISSIVE"`` is asked
    for; it never turns into a silent NULL."""
    defaults = {"sep": sep, "header": True, "enforceSchema": False} | ({"mode": "FAILFAST"} if schema else {})
    reader = spark.read.options(**defaults | options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    return df.select("*", source_name().alias(SOURCE_COLUMN)) if tag_source else df


def latest_files(listing: DataFrame) -> DataFrame:
    """``(folder, file_name, path)`` of the file with the greatest name in each folder."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")
    return (
        listing.groupBy(folder)
        .agg(F.max_by(F.struct("file_name", "path"), "file_name").alias("latest"))
        .select("folder", "latest.*")
    )


def read_latest(spark: SparkSession, folder: str, pattern: str = "*.csv", **csv: object) -> DataFrame:
    """The newest file of a folder, or of each folder below it; older files stay unread."""
    newest = latest_files(discover_files(spark, folder, pattern, recursive=True)).select("path").collect()
    return read_market_csv(spark, [literal_path(r.path) for r in newest], **csv)


def read_by_header(
    spark: SparkSession, listing: DataFrame, sep: str = ";", tag_source: bool = False, **options: str
) -> DataFrame:
    """Files whose headers differ: one scan per distinct header, unioned by column name.

    Header lines are found by Spark (first line of each file), and only the distinct
    headers with their paths come back to build the scans."""
    paths = [literal_path(r.path) for r in listing.select("path").collect()]
    lines = spark.read.text(paths).select(
        "value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")
    )
    headers = (
        lines.filter("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("header")).collect()
    )
    groups: dict[str, list[str]] = {}
    for row in headers:
        groups.setdefault(row.header, []).append(literal_path(unquote(row.file_path)))
    frames = [read_market_csv(spark, group, sep, tag_source=tag_source, **options) for group in groups.values()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def flatten_listing(pages: DataFrame) -> DataFrame:
    """Names of all listing pages in page order. ``pages`` has (page, contentItemList)."""
    items = pages.select("page", F.posexplode("contentItemList").alias("pos", "item"))
    return items.select("page", "pos", F.col("item.name").alias("name")).orderBy("page", "pos")


def parse_listing(pages: DataFrame, document: str) -> DataFrame:
    """Listing pages held as JSON text, one page object per row."""
    return pages.select(F.from_json(document, LISTING_SCHEMA).alias("p")).select("p.*")


def write_then_read(df: DataFrame, path: str, fmt: str, **options: str) -> DataFrame:
    """Write a frame in a file format and read it back. CSV comes back as text."""
    df.write.format(fmt).options(**options).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).options(**options).load(path)
