"""Python-function surface. Grouped functions get pre-aggregated rows, so that a group is
bounded by the calendar and not by the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.functions import python_functions as p
from gridlake.operators.windows import match_keys
from gridlake.session import small_side
from gridlake.suite.registry import query, table


@query("udf_scalar", "SELECT event_id, user_id + 1 AS user_id FROM events")
def scalar(spark, sf):
    return table(spark, sf, "events").select("event_id", p.plus_one("user_id").alias("user_id"))


@query("udf_map", "SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")
def map_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return p.map_batches(events, lambda pdf: pdf[pdf.event_type == "click"])


@query(
    "udf_sql",
    "SELECT l_orderkey, l_partkey, CAST(l_linenumber + 1 AS INTEGER) AS next_line FROM lineitem",
)
def sql_function(spark, sf):
    p.register_sql_functions(spark)
    lines = table(spark, sf, "lineitem")
    return lines.selectExpr("l_orderkey", "l_partkey", "add_one(l_linenumber) AS next_line")


_DAILY_SQL = """daily AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)"""


def _daily(spark, sf):
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query(
    "udf_group",
    f"""WITH {_DAILY_SQL}
    SELECT day, event_type, round(n - avg(n) OVER (PARTITION BY event_type), 6) AS n FROM daily""",
)
def grouped(spark, sf):
    daily = _daily(spark, sf).withColumn("n", F.col("n").cast("double"))
    centred = daily.groupBy("event_type").applyInPandas(p.demean("n"), schema=daily.schema)
    return centred.withColumn("n", F.round("n", 6))


@query(
    "udf_group_native",
    """SELECT event_id, event_type, round(value - avg(value) OVER (PARTITION BY event_type), 4) AS value FROM events""",
)
def grouped_native(spark, sf):
    """The same on raw rows with built-ins: means first, then one pass over the rows."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    means = small_side(events.groupBy("event_type").agg(F.avg("value").alias("_mean")))
    joined = match_keys(events, means, ["event_type"])
    return joined.select("event_id", "event_type", F.round(F.col("value") - F.col("_mean"), 4).alias("value"))
