"""Stand-ins for the market tables, derived from the benchmark tables, and the same
derivations as SQL relations for the oracle statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.values import bin_floor, interval_start
from gridlake.suite.registry import table

# Bids: events whose value is put on a price ladder of 5, from -50 up; a few have no price.
BIDS_SQL = """bids AS (
  SELECT event_id, event_type AS area, user_id AS area_code,
         CASE WHEN value >= 1.0 THEN floor(value / 5.0) * 5.0 - 50.0 END AS price,
         value AS volume,
         CASE WHEN value < 60.0 THEN 'Down' ELSE 'Up' END AS direction,
         CASE user_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'UAH' END AS currency,
         time_bucket(INTERVAL '15 minutes', ts) AS period_start,
         time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS period_end
  FROM events)"""


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = interval_start(F.col("ts"), 15)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("area"),
        F.col("user_id").alias("area_code"),
        F.when(F.col("value") >= 1.0, bin_floor(F.col("value"), 5.0).cast("double") - 50.0).alias("price"),
        F.col("value").alias("volume"),
        F.when(F.col("value") < 60.0, "Down").otherwise("Up").alias("direction"),
        F.when(F.col("user_id") % 3 == 0, "EUR").when(F.col("user_id") % 3 == 1, "UAH").alias("currency"),
        start.alias("period_start"),
        (start + F.expr("INTERVAL 15 MINUTES")).alias("period_end"),
    )


# Prices: events around zero, in three currency cases (one of them unknown).
PRICES_SQL = """prices AS (
  SELECT event_type AS zone, ts AS instant,
         CASE WHEN value >= 0.5 THEN value - 100.0 END AS price,
         CASE user_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'UAH' END AS currency
  FROM events)"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("zone"),
        F.col("ts").alias("instant"),
        F.when(F.col("value") >= 0.5, F.col("value") - 100.0).alias("price"),
        F.when(F.col("user_id") % 3 == 0, "EUR").when(F.col("user_id") % 3 == 1, "UAH").alias("currency"),
    )


# Units: one row per order line; a unit is a (supplier, part) pair listed many times.
UNITS_SQL = """units AS (
  SELECT n_name AS area, l_suppkey, l_partkey, p_type AS fuel, p_size AS capacity,
         CASE l_linestatus WHEN 'F' THEN 'COMMISSIONED' ELSE 'DECOMMISSIONED' END AS status,
         CAST(l_shipdate AS VARCHAR) AS valid_from,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate + INTERVAL '1 year' AS VARCHAR) END AS valid_to
  FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    joined = (
        lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("n_name").alias("area"),
        "l_suppkey",
        "l_partkey",
        F.col("p_type").alias("fuel"),
        F.col("p_size").alias("capacity"),
        F.when(F.col("l_linestatus") == "F", "COMMISSIONED").otherwise("DECOMMISSIONED").alias("status"),
        F.col("l_shipdate").alias("valid_from"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate") + F.expr("INTERVAL 1 YEAR")).alias("valid_to"),
    )
