"""Sources, sinks and ingestion. Every query first derives files from a benchmark table,
written to the shared folder the session names."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F

from gridlake.functions.headers import coerce_text, normalise_columns
from gridlake.plans.ingest import SOURCE_COLUMN, Target, audit, ingest_folder
from gridlake.session import scratch_path
from gridlake.sources import files as s
from gridlake.sources.dialects import read_sniffed
from gridlake.suite.registry import query, table

# Events with the raw headers of a market publication.
MARKET_HEADERS = {
    "event_id": "Event Id",
    "event_type": "AreaDisplayName",
    "value": "Price[Currency/MWh]",
    "user_id": "Volume[MW]",
}
MARKET_SCHEMA = "`Event Id` BIGINT, AreaDisplayName STRING, `Price[Currency/MWh]` DOUBLE, `Volume[MW]` BIGINT"
MARKET_SQL = """SELECT event_id, event_type AS areadisplayname, value AS price_currency_mwh, user_id AS volume_mw
                FROM events"""


def _market_rows(spark, sf):
    return table(spark, sf, "events").select(*[F.col(c).alias(h) for c, h in MARKET_HEADERS.items()])


def _write_market_csv(spark, sf, label, by_area=False):
    path = scratch_path(spark, label)
    rows = _market_rows(spark, sf)
    if by_area:
        writer = rows.withColumn("area", F.col("AreaDisplayName")).write.partitionBy("area")
    else:
        writer = rows.write
    writer.csv(path, sep=";", header=True)
    return path


@query("src_csv", MARKET_SQL)
def market_csv(spark, sf):
    path = _write_market_csv(spark, sf, "src_csv")
    return normalise_columns(s.read_market_csv(spark, path, schema=MARKET_SCHEMA))


@query("src_csv_inferred", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def inferred_csv(spark, sf):
    path = scratch_path(spark, "src_csv_inferred")
    table(spark, sf, "customer").write.csv(path, header=True)
    df = s.read_market_csv(spark, path, sep=",")
    return df.withColumn("c_custkey", F.col("c_custkey").cast("long"))


_SNIFFED_SQL = """SELECT c_custkey, c_name || ', ' || c_mktsegment || '; ' || c_nationkey AS who, c_acctbal FROM customer"""


@query("src_csv_sniffed", _SNIFFED_SQL)
def sniffed_csv(spark, sf):
    """Customers in files of four dialects, told apart by what stands in them."""
    path = scratch_path(spark, "src_csv_sniffed")
    who = F.concat("c_name", F.lit(", "), "c_mktsegment", F.lit("; "), F.col("c_nationkey").cast("string"))
    rows = table(spark, sf, "customer").select("c_custkey", who.alias("who"), F.col("c_acctbal").cast("string").alias("c_acctbal"))
    comma = F.replace("c_acctbal", F.lit("."), F.lit(","))
    dialects = [(";", '"', comma), (",", '"', F.col("c_acctbal")), ("\t", '"', comma), ("|", "'", F.col("c_acctbal"))]
    for i, (sep, quote, balance) in enumerate(dialects):
        part = rows.where(F.col("c_custkey") % len(dialects) == i).withColumn("c_acctbal", balance)
        part.write.mode("append").csv(path, sep=sep, quote=quote, header=True)
    return read_sniffed(spark, path).select("c_custkey", "who", "c_acctbal")


@query("src_discover", "SELECT DISTINCT 'area=' || event_type AS folder, true AS has_files FROM events")
def discover(spark, sf):
    path = _write_market_csv(spark, sf, "src_discover", by_area=True)
    found = s.prefer_local(s.discover_files(spark, path, recursive=True), s.discover_files(spark, path))
    folder = F.element_at(F.split("path", "/"), -2)
    return found.groupBy(folder.alias("folder")).agg((F.count("*") > 0).alias("has_files"))


@query(
    "src_listing_pages",
    """SELECT CAST(c_custkey // 1000 AS INTEGER) AS page, CAST(c_custkey % 1000 AS INTEGER) AS pos, c_name AS name
       FROM customer""",
)
def listing_pages(spark, sf):
    # Pages of 1000 names, as one JSON document each (customer keys are dense from 0).
    page = F.floor(F.col("c_custkey") / 1000).cast("int").alias("page")
    items = F.transform(
        F.array_sort(F.collect_list(F.struct("c_custkey", F.col("c_name").alias("name")))),
        lambda item: F.struct(item["name"].alias("name")),
    )
    pages = table(spark, sf, "customer").groupBy(page).agg(items.alias("contentItemList"))
    path = scratch_path(spark, "src_listing_pages")
    pages.select(F.to_json(F.struct("page", "contentItemList")).alias("value")).write.text(path)
    return s.flatten_listing(s.parse_listing(spark.read.text(path), "value"))


@query(
    "src_rows",
    """WITH rates AS (SELECT * FROM (VALUES ('BUILDING', 1.0::DOUBLE), ('MACHINERY', 0.5::DOUBLE)) t(segment, rate))
       SELECT c_mktsegment, max(rate) AS rate, count(*) AS n
       FROM customer LEFT JOIN rates ON c_mktsegment = segment GROUP BY c_mktsegment""",
)
def local_rows(spark, sf):
    rates = spark.createDataFrame([Row(segment="BUILDING", rate=1.0), Row(segment="MACHINERY", rate=0.5)])
    customers = table(spark, sf, "customer").select("c_mktsegment")
    # The local relation has two rows, so the hint is safe whatever the table's size.
    joined = customers.join(F.broadcast(rates), F.col("c_mktsegment") == F.col("segment"), "left")
    return joined.groupBy("c_mktsegment").agg(F.max("rate").alias("rate"), F.count("*").alias("n"))


@query(
    "io_csv",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
)
def io_csv(spark, sf):
    return s.write_then_read(table(spark, sf, "customer"), scratch_path(spark, "io_csv"), "csv", header="true")


@query("io_parquet", "SELECT * FROM orders")
def io_parquet(spark, sf):
    return s.write_then_read(table(spark, sf, "orders"), scratch_path(spark, "io_parquet"), "parquet")


@query("io_orc", "SELECT * FROM orders")
def io_orc(spark, sf):
    return s.write_then_read(table(spark, sf, "orders"), scratch_path(spark, "io_orc"), "orc")


@query("ing_columns", MARKET_SQL)
def columns(spark, sf):
    return normalise_columns(_market_rows(spark, sf))


@query(
    "ing_tag",
    """SELECT event_type AS area, true AS tagged, count(*) AS n FROM events GROUP BY event_type""",
)
def tag(spark, sf):
    path = _write_market_csv(spark, sf, "ing_tag", by_area=True)
    rows = s.read_market_csv(spark, path, schema=MARKET_SCHEMA + ", area STRING", tag_source=True, enforceSchema="true")
    tagged = F.col(SOURCE_COLUMN).rlike(r"^part-.*\.csv$").alias("tagged")
    return rows.groupBy("area", tagged).agg(F.count("*").alias("n"))


@query(
    "ing_text",
    """SELECT vec_id, label, '{"dims":' || len(embedding) || '}' AS shape FROM embeddings""",
)
def text(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", F.struct(F.size("embedding").alias("dims")).alias("shape"))
    return coerce_text(rows)


@query(
    "ing_audit",
    """SELECT c_mktsegment, count(*) AS rows, count(c_custkey) AS c_custkey_present,
              count(nullif(c_nationkey, 0)) AS c_nationkey_present, count(c_name) AS c_name_present,
              count(c_acctbal) AS c_acctbal_present
       FROM customer GROUP BY c_mktsegment""",
)
def batch_audit(spark, sf):
    rows = table(spark, sf, "customer").withColumn("c_nationkey", F.nullif(F.col("c_nationkey"), F.lit(0)))
    return audit(rows, "c_mktsegment")


def _ingest(spark, sf, label, runs):
    """Land the events as market files, several times over, and return the target."""
    base = scratch_path(spark, label)
    _market_rows(spark, sf).write.csv(f"{base}/landing/Prices_r3", sep=";", header=True)
    target = Target(f"{base}/raw", database=f"bronze_{base[-32:]}", location=f"{base}/bronze")
    for force in runs:
        ingest_folder(spark, f"{base}/landing", "Prices_r3", target, force=force, schema=MARKET_SCHEMA)
    return target


@query(
    "ingest_types",
    """SELECT o_orderkey AS order_id, o_orderdate AS at,
              CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS DOUBLE) ELSE o_totalprice END AS price FROM orders""",
)
def ingest_types(spark, sf):
    """Two deliveries with inferred types and a timestamp: whole numbers first, fractions next.
    The table's column widens, and no fraction is cut off."""
    base = scratch_path(spark, "ingest_types")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    target = Target(f"{base}/raw", database=f"bronze_{base[-32:]}", location=f"{base}/bronze")
    for part, price in ((0, F.col("o_custkey")), (1, F.col("o_totalprice"))):
        rows = orders.where(F.col("o_orderkey") % 2 == part)
        rows = rows.select(F.col("o_orderkey").alias("Order Id"), F.col("o_orderdate").alias("At"), price.alias("Price"))
        rows.write.mode("append").csv(f"{base}/landing/Prices, 12.1 (x)&y", sep=";", header=True)
        ingest_folder(spark, f"{base}/landing", "Prices, 12.1 (x)&y", target)
    landed = spark.table(target.full_name("Prices, 12.1 (x)&y"))
    return landed.select(F.col("order_id").cast("long").alias("order_id"), F.col("at").cast("timestamp_ntz").alias("at"), "price")


@query("ingest_raw", MARKET_SQL)
def ingest_raw(spark, sf):
    target = _ingest(spark, sf, "ingest_raw", [False])
    return spark.read.parquet(target.raw_path).drop("_folder", SOURCE_COLUMN)


@query("ingest_bronze", MARKET_SQL)
def ingest_bronze(spark, sf):
    """First run, a repeat that finds nothing to do, and a forced reload: same rows."""
    target = _ingest(spark, sf, "ingest_bronze", [False, False, True])
    return spark.table(target.full_name("Prices_r3")).drop(SOURCE_COLUMN)


@query(
    "ingest_whole_numbers",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN CAST(9007199254740993 + o_orderkey AS VARCHAR)
              ELSE CAST(o_orderkey AS VARCHAR) || '.5' END AS price FROM orders""",
)
def ingest_whole_numbers(spark, sf):
    """Whole numbers that a double would round, then fractions: the column turns to text, digit for digit."""
    base = scratch_path(spark, "ingest_whole")
    target = Target(f"{base}/raw", database=f"bronze_{base[-32:]}", location=f"{base}/bronze")
    key = F.col("o_orderkey")
    for part, price in ((0, F.lit(9007199254740993) + key), (1, F.concat(key.cast("string"), F.lit(".5")))):
        rows = table(spark, sf, "orders").where(key % 2 == part).select(key.alias("Order Id"), price.alias("Price"))
        rows.write.mode("append").csv(f"{base}/landing/Whole", sep=";", header=True)
        ingest_folder(spark, f"{base}/landing", "Whole", target)
    return spark.table(target.full_name("Whole")).select(F.col("order_id").cast("long").alias("order_id"), "price")
