"""The SQL surface: market tables as views, queried by text.

Raw headers are written in back-quotes; groups may be given by position or alias."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.suite.registry import query, table
from gridlake.suite.standins import BIDS_SQL, PRICES_SQL, bids, prices


@query(
    "sql_price_bins",
    f"""WITH {PRICES_SQL}, bins AS (
      SELECT zone, CAST(floor(CASE WHEN currency = 'UAH' THEN price * 0.023 ELSE price END / 10.0) * 10 AS INTEGER) AS bin,
             count(*) AS n
      FROM prices GROUP BY 1, 2)
    SELECT zone, bin, n,
           round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY zone), 2) AS share,
           round(100.0::DOUBLE * sum(n) OVER (PARTITION BY zone ORDER BY bin NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(n) OVER (PARTITION BY zone), 2) AS cumulative
    FROM bins""",
)
def price_bins(spark, sf):
    prices(spark, sf).createOrReplaceTempView("gridlake_prices")
    return spark.sql(
        """
        WITH bins AS (
          SELECT zone,
                 CAST(floor(CASE WHEN currency = 'UAH' THEN price * 0.023D ELSE price END / 10.0D) * 10 AS INT) AS bin,
                 count(*) AS n
          FROM gridlake_prices GROUP BY 1, 2)
        SELECT zone, bin, n,
               round(100.0D * n / sum(n) OVER (PARTITION BY zone), 2) AS share,
               round(100.0D * sum(n) OVER running / sum(n) OVER (PARTITION BY zone), 2) AS cumulative
        FROM bins
        WINDOW running AS (PARTITION BY zone ORDER BY bin NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        ORDER BY zone, bin NULLS LAST
        """
    )


@query(
    "sql_raw_headers",
    f"""WITH {BIDS_SQL}
    SELECT area AS "AreaDisplayName", price AS level, count(*) AS frequency, min(period_start) AS first_seen
    FROM bids WHERE price = (SELECT min(price) FROM bids WHERE area = 'view') GROUP BY area, price""",
)
def raw_headers(spark, sf):
    raw = {"area": "AreaDisplayName", "price": "Price[Currency/MWh]", "period_start": "DeliveryPeriodStart(UTC)"}
    renamed = bids(spark, sf).select(*[F.col(c).alias(h) for c, h in raw.items()])
    renamed.createOrReplaceTempView("gridlake_raw_bids")
    return spark.sql(
        """
        SELECT AreaDisplayName, `Price[Currency/MWh]` AS level, count(*) AS frequency,
               min(`DeliveryPeriodStart(UTC)`) AS first_seen
        FROM gridlake_raw_bids
        WHERE `Price[Currency/MWh]` = (SELECT min(`Price[Currency/MWh]`) FROM gridlake_raw_bids WHERE AreaDisplayName = :area)
        GROUP BY 1, level
        """,
        args={"area": "view"},
    )


@query(
    "sql_aggregates",
    "SELECT o_orderstatus AS status, count(*) AS n, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY 1",
)
def aggregates(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("gridlake_orders")
    return spark.sql(
        "SELECT o_orderstatus AS status, count(*) AS n, round(avg(o_totalprice), 2) AS mean "
        "FROM gridlake_orders GROUP BY status ORDER BY 2 DESC"
    )
