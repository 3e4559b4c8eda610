"""Window operators on raw rows of the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import windows as w
from gridlake.suite.registry import query, table


@query(
    "win_share",
    """SELECT o_orderkey, o_orderpriority, o_totalprice,
              round(100.0::DOUBLE * o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 6) AS share_pct
       FROM orders""",
)
def share(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return w.share_of_total(orders, "o_orderpriority", "o_totalprice", digits=6)


@query(
    "win_dense_rank",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice,
              dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS rank
       FROM lineitem""",
)
def dense_rank(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice"
    )
    return w.with_dense_rank(lines, "l_returnflag", "l_extendedprice")


@query(
    "win_cumulative",
    """SELECT event_id, event_type,
              CAST(round(sum(CAST(round(value * 100) AS BIGINT)) OVER (
                PARTITION BY event_type ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS BIGINT) AS running
       FROM events""",
)
def cumulative(spark, sf):
    cents = F.round(F.col("value") * 100).cast("long")
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", cents.alias("cents"))
    return w.running_total(events, "event_type", ["ts", "event_id"], "cents").drop("ts", "cents")


@query(
    "win_moving_avg",
    """SELECT event_id, event_type, round(avg(value) OVER (
                PARTITION BY event_type ORDER BY ts, event_id
                ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS smoothed
       FROM events""",
)
def moving_avg(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    smoothed = w.centred_mean(events, "event_type", ["ts", "event_id"], "value")
    return smoothed.select("event_id", "event_type", F.round("smoothed", 6).alias("smoothed"))


@query(
    "win_topn",
    """SELECT o_orderkey, o_orderpriority, o_totalprice, rank FROM (
         SELECT o_orderkey, o_orderpriority, o_totalprice,
                dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank
         FROM orders) WHERE rank <= 10""",
)
def topn(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return w.dense_top_n(orders, "o_orderpriority", "o_totalprice", 10)
