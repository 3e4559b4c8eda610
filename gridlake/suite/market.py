"""The analyst query set on the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import maintained
from gridlake.operators import market as m
from gridlake.plans.versions import VersionedTable
from gridlake.session import scratch_path
from gridlake.sources.files import SOURCE_COLUMN
from gridlake.suite.registry import query
from gridlake.suite.standins import BIDS_SQL, PRICES_SQL, UNITS_SQL, bids, prices, units


@query(
    "a02_top_groups",
    f"""WITH {BIDS_SQL}
    SELECT area_code, count(*) AS count FROM bids GROUP BY area_code
    ORDER BY count DESC, area_code LIMIT 10""",
)
def top_groups(spark, sf):
    return m.most_frequent(bids(spark, sf), "area_code")


@query(
    "a03_price_stats",
    f"""WITH {BIDS_SQL}
    SELECT area, round(avg(price), 2) AS avg_price, min(price) AS min_price,
           max(price) AS max_price, count(*) AS bid_count
    FROM bids WHERE price IS NOT NULL GROUP BY area ORDER BY avg_price DESC""",
)
def price_stats(spark, sf):
    return m.price_stats(bids(spark, sf), "area", "price")


@query(
    "a04_totals",
    f"""WITH {BIDS_SQL}
    SELECT direction, count(*) AS total_bids, round(sum(volume), 0) AS total_volume_mw,
           round(avg(price), 2) AS avg_price
    FROM bids GROUP BY direction""",
)
def totals(spark, sf):
    return m.direction_totals(bids(spark, sf), "direction", "volume", "price")


@query(
    "a05_topk",
    f"""WITH {BIDS_SQL}
    SELECT area, volume, price, direction, period_start FROM bids
    ORDER BY volume DESC, event_id LIMIT 20""",
)
def topk(spark, sf):
    columns = ["area", "volume", "price", "direction", "period_start"]
    return m.largest(bids(spark, sf), columns, "volume", ["event_id"])


@query(
    "a06_distinct_negatives",
    f"""WITH {BIDS_SQL}
    SELECT price, currency FROM bids WHERE price < 0 GROUP BY price, currency
    ORDER BY price, currency NULLS LAST LIMIT 100""",
)
def distinct_negatives(spark, sf):
    return m.negative_levels(bids(spark, sf), "price", "currency")


@query(
    "a07_extreme_dwell",
    f"""WITH {BIDS_SQL}, floors AS (SELECT area, min(price) AS lowest FROM bids GROUP BY area)
    SELECT b.area, price, count(*) AS intervals_count, count(*) * 15 AS total_minutes,
           round(CAST(count(*) * 15 AS DOUBLE) / 60.0, 2) AS total_hours,
           min(period_start) AS first_seen, max(period_end) AS last_seen
    FROM bids b JOIN floors f ON b.area = f.area AND b.price = f.lowest
    GROUP BY b.area, price""",
)
def extreme_dwell(spark, sf):
    return m.dwell_at_minimum(bids(spark, sf), "area", "price", "period_start", "period_end")


@query(
    "a07_extreme_dwell_one_area",
    f"""WITH {BIDS_SQL}
    SELECT area, price, count(*) AS intervals_count, count(*) * 15 AS total_minutes,
           round(CAST(count(*) * 15 AS DOUBLE) / 60.0, 2) AS total_hours,
           min(period_start) AS first_seen, max(period_end) AS last_seen
    FROM bids
    WHERE area = 'purchase' AND price = (SELECT min(price) FROM bids WHERE area = 'purchase')
    GROUP BY area, price""",
)
def extreme_dwell_one_area(spark, sf):
    return m.dwell_at_minimum(bids(spark, sf), "area", "price", "period_start", "period_end", "purchase")


@query(
    "a08_negative_levels",
    f"""WITH {BIDS_SQL}
    SELECT price, count(*) AS frequency, min(period_start) AS sample_time
    FROM bids WHERE area = 'purchase' AND price < 0 GROUP BY price ORDER BY price LIMIT 20""",
)
def negative_levels(spark, sf):
    return m.level_frequency(bids(spark, sf), "area", "purchase", "price", "period_start")


_DWELL_SQL = f"""WITH {BIDS_SQL}
    SELECT area, price, count(DISTINCT period_start) AS unique_intervals,
           round(CAST(count(DISTINCT period_start) * 15 AS DOUBLE) / 60.0, 2) AS actual_hours_at_floor,
           round(CAST(count(*) AS DOUBLE) / count(DISTINCT period_start), 1) AS bids_density
    FROM bids {{where}} GROUP BY area, price"""


@query("a09_interval_dwell", _DWELL_SQL.format(where="WHERE area = 'click' AND price = -50.0"))
def interval_dwell(spark, sf):
    return m.dwell_at_level(bids(spark, sf), "area", "price", "period_start", level=-50.0, only_area="click")


@query("a09_interval_dwell_all_levels", _DWELL_SQL.format(where=""))
def interval_dwell_all_levels(spark, sf):
    return m.dwell_at_level(bids(spark, sf), "area", "price", "period_start")


@query(
    "a10_floor_total",
    f"""WITH {BIDS_SQL}, starts AS (
      SELECT DISTINCT period_start FROM bids WHERE area = 'click' AND price = -50.0)
    SELECT count(*) AS total_intervals, CAST(count(*) * 15 AS DOUBLE) / 60.0 AS real_hours_at_the_floor
    FROM starts""",
)
def floor_total(spark, sf):
    return m.floor_total(bids(spark, sf), "area", "click", "price", "period_start", -50.0)


@query(
    "a11_capacity_share",
    f"""WITH {UNITS_SQL}, live AS (
      SELECT DISTINCT area AS country, l_suppkey, l_partkey, fuel AS fuel_type, capacity
      FROM units
      WHERE fuel IS NOT NULL AND capacity > 0 AND status = 'COMMISSIONED'
        AND CAST(valid_from AS TIMESTAMP) <= TIMESTAMP '1999-06-01 00:00:00'
        AND (valid_to IS NULL OR CAST(valid_to AS TIMESTAMP) > TIMESTAMP '1999-06-01 00:00:00')),
    totals AS (
      SELECT country, fuel_type, CAST(sum(capacity) AS BIGINT) AS total_mw FROM live GROUP BY country, fuel_type),
    ranked AS (
      SELECT fuel_type, dense_rank() OVER (PARTITION BY fuel_type ORDER BY total_mw DESC) AS rank_in_europe,
             country, round(total_mw, 0) AS capacity_mw,
             round(100.0::DOUBLE * total_mw / sum(total_mw) OVER (PARTITION BY fuel_type), 2) AS "%_of_EU_fuel",
             round(100.0::DOUBLE * total_mw / sum(total_mw) OVER (PARTITION BY country), 2) AS "%_of_country_mix"
      FROM totals)
    SELECT fuel_type, CAST(rank_in_europe AS BIGINT) AS rank_in_europe, country,
           CAST(capacity_mw AS BIGINT) AS capacity_mw, "%_of_EU_fuel", "%_of_country_mix"
    FROM ranked WHERE rank_in_europe <= 10""",
)
def capacity_share(spark, sf):
    return m.capacity_share(
        units(spark, sf), "area", ["l_suppkey", "l_partkey"], "fuel", "capacity", "status",
        "valid_from", "valid_to", "1999-06-01 00:00:00",
    )


@query(
    "a12_currency_range",
    f"""WITH {PRICES_SQL}
    SELECT currency, count(*) AS records_count, min(price) AS min_raw_price, max(price) AS max_raw_price
    FROM prices GROUP BY currency""",
)
def currency_range(spark, sf):
    return m.currency_range(prices(spark, sf), "currency", "price")


_EUR_SQL = "CASE WHEN currency = 'UAH' THEN price * 0.023 ELSE price END"


@query(
    "a13_fx_avg",
    f"""WITH {PRICES_SQL}
    SELECT zone AS bidding_zone, round(avg({_EUR_SQL}), 2) AS avg_price_eur
    FROM prices GROUP BY zone ORDER BY avg_price_eur DESC""",
)
def fx_avg(spark, sf):
    return m.average_price(prices(spark, sf), "zone", "price", "currency")


@query(
    "a14_price_bins",
    f"""WITH {PRICES_SQL}, bins AS (
      SELECT zone AS bidding_zone, CAST(floor(({_EUR_SQL}) / 10.0) * 10 AS INTEGER) AS price_bin_eur,
             count(*) AS hours_count
      FROM prices GROUP BY 1, 2)
    SELECT bidding_zone, price_bin_eur, hours_count,
           round(100.0::DOUBLE * hours_count / sum(hours_count) OVER (PARTITION BY bidding_zone), 2) AS bin_share_pct,
           round(100.0::DOUBLE * sum(hours_count) OVER (PARTITION BY bidding_zone ORDER BY price_bin_eur NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 / sum(hours_count) OVER (PARTITION BY bidding_zone), 2) AS cumulative_share_pct,
           round(avg(hours_count) OVER (PARTITION BY bidding_zone ORDER BY price_bin_eur NULLS LAST
                   ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 1) AS smoothed_hours_count
    FROM bins""",
)
def price_bins(spark, sf):
    return m.price_bins(prices(spark, sf), "zone", "price", "currency")


@query(
    "a15_price_window",
    f"""WITH {PRICES_SQL}
    SELECT instant, price FROM prices
    WHERE zone = 'view' AND instant >= TIMESTAMP '2024-01-09 23:00:00' AND instant < TIMESTAMP '2024-01-19 23:00:00'
    ORDER BY instant""",
)
def price_window(spark, sf):
    return m.price_window(
        prices(spark, sf), "zone", "view", "instant", ["instant", "price"], "2024-01-10", "2024-01-20", "Europe/Brussels"
    )


@query(
    "a07_dwell_periods",
    f"""WITH {BIDS_SQL}, held AS (
      SELECT area, price, period_start AS s, period_start + INTERVAL 15 MINUTE * (1 + event_id % 5) AS e
      FROM bids b WHERE price = (SELECT min(price) FROM bids f WHERE f.area = b.area)),
    marked AS (
      SELECT *, max(e) OVER (PARTITION BY area ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM held),
    spells AS (
      SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY area ORDER BY s, e) AS spell FROM marked),
    merged AS (SELECT area, price, spell, min(s) AS s, max(e) AS e FROM spells GROUP BY ALL)
    SELECT area, price, count(*) AS spells, round(sum(epoch(e - s)) / 60, 2) AS total_minutes,
           round(sum(epoch(e - s)) / 3600, 2) AS total_hours, min(s) AS first_seen, max(e) AS last_seen
    FROM merged GROUP BY area, price""",
)
def dwell_periods(spark, sf):
    """Bids of one to five intervals each; many hold at the same time."""
    rows = bids(spark, sf)
    later = F.col("period_start") + F.make_dt_interval(F.lit(0), F.lit(0), (15 * (1 + F.col("event_id") % 5)).cast("int"))
    return m.dwell_periods(rows.withColumn("period_end", later), "area", "price", "period_start", "period_end")


@query(
    "a11_capacity_over_time",
    f"""WITH {UNITS_SQL}, listed AS (
      SELECT area, l_suppkey, l_partkey, fuel, capacity, CAST(valid_from AS TIMESTAMP) AS f, CAST(valid_to AS TIMESTAMP) AS t
      FROM units WHERE fuel IS NOT NULL AND capacity > 0 AND status = 'COMMISSIONED'),
    ends AS (
      SELECT area, l_suppkey, l_partkey, fuel, capacity, f AS since, 1 AS change FROM listed WHERE t IS NULL OR t > f
      UNION ALL SELECT area, l_suppkey, l_partkey, fuel, capacity, t, -1 FROM listed WHERE t > f),
    summed AS (SELECT area, l_suppkey, l_partkey, fuel, capacity, since, sum(change) AS change FROM ends GROUP BY ALL HAVING sum(change) <> 0),
    counted AS (
      SELECT *, sum(change) OVER (PARTITION BY area, l_suppkey, l_partkey, fuel, capacity ORDER BY since) AS listings FROM summed),
    steps AS (
      SELECT area, fuel, since, sum(CASE WHEN listings = 0 THEN -capacity ELSE capacity END) AS mw
      FROM counted WHERE listings = 0 OR listings = change GROUP BY ALL HAVING sum(CASE WHEN listings = 0 THEN -capacity ELSE capacity END) <> 0)
    SELECT area AS country, fuel AS fuel_type, since,
           CAST(sum(mw) OVER (PARTITION BY area, fuel ORDER BY since) AS BIGINT) AS total_mw FROM steps""",
)
def capacity_over_time(spark, sf):
    return m.capacity_over_time(
        units(spark, sf), "area", ["l_suppkey", "l_partkey"], "fuel", "capacity", "status", "valid_from", "valid_to"
    )


# Prices by delivery: the weekday names the source. Two sources are replaced by other rows.
_SOURCED_SQL = PRICES_SQL + """, sourced AS (
  SELECT zone, instant, currency, CASE WHEN dayofweek(instant) IN (1, 3) THEN price + 7.0 ELSE price END AS price
  FROM prices WHERE dayofweek(instant) <> 3 OR currency IS NOT NULL)"""


def maintained_prices(spark, sf):
    """A table of seven sources and its bins, before and after two of the sources were replaced."""
    base = scratch_path(spark, "maintained")
    database = f"bronze_{base[-32:]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    rows = VersionedTable(spark, database, "prices", f"{base}/prices")
    bins = maintained.price_bins(rows, VersionedTable(spark, database, "price_bins", f"{base}/price_bins"), "zone", "price", "currency")
    day = F.dayofweek("instant") - 1
    sourced = prices(spark, sf).withColumn(SOURCE_COLUMN, F.concat(F.lit("day "), day.cast("string"), F.lit(".csv")))

    def deliver(batch):
        counts = batch.groupBy(SOURCE_COLUMN).agg(F.count("*").alias("rows"))
        rows.publish(batch, counts)

    deliver(sourced)
    first = bins.refresh()
    again = sourced.where(day.isin(1, 3)).withColumn("price", F.col("price") + 7.0).where((day != 3) | F.col("currency").isNotNull())
    deliver(again)
    return bins, first, bins.refresh()


@query(
    "a14_maintained",
    f"""WITH {_SOURCED_SQL}, bins AS (
      SELECT zone AS bidding_zone, CAST(floor(({_EUR_SQL}) / 10.0) * 10 AS INTEGER) AS price_bin_eur,
             count(*) AS hours_count
      FROM sourced GROUP BY 1, 2)
    SELECT bidding_zone, price_bin_eur, hours_count,
           round(100.0::DOUBLE * hours_count / sum(hours_count) OVER (PARTITION BY bidding_zone), 2) AS bin_share_pct,
           round(100.0::DOUBLE * sum(hours_count) OVER (PARTITION BY bidding_zone ORDER BY price_bin_eur NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 / sum(hours_count) OVER (PARTITION BY bidding_zone), 2) AS cumulative_share_pct,
           round(avg(hours_count) OVER (PARTITION BY bidding_zone ORDER BY price_bin_eur NULLS LAST
                   ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 1) AS smoothed_hours_count
    FROM bins""",
)
def bins_maintained(spark, sf):
    bins, _, _ = maintained_prices(spark, sf)
    return maintained.price_bins_report(bins)
