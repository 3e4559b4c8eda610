"""The analyst query set. Column names are arguments, so the same operator runs on
market files and on any other table.

Grouped results come from algebraic aggregates with map-side combining: a key that holds
a third of the rows costs one partial row per task. Windows appear only over aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.values import (
    bin_floor,
    converted_price,
    in_zoned_window,
    interval_hours,
    is_valid_at,
)
from gridlake.operators.windows import (
    centred_mean_column,
    cumulative_share_column,
    dense_rank_column,
    in_ranges,
    match_keys,
    running_total,
    share_column,
)
from gridlake.session import small_side

# Delivery interval in minutes, bin width, and the one conversion rate.
INTERVAL_MINUTES = 15
BIN_WIDTH = 10.0
RATES = {"UAH": 0.023}


def most_frequent(df: DataFrame, area: str, k: int = 10) -> DataFrame:
    """The ``k`` areas with most rows; ties fall to the smaller name."""
    counted = df.groupBy(area).agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), F.col(area).asc_nulls_last()).limit(k)


def price_stats(df: DataFrame, area: str, price: str) -> DataFrame:
    """Average, range and count per area over rows that have a price."""
    stats = (
        df.filter(F.col(price).isNotNull())
        .groupBy(area)
        .agg(
            F.round(F.avg(price), 2).alias("avg_price"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
            F.count("*").alias("bid_count"),
        )
    )
    return stats.orderBy(F.desc("avg_price"), F.col(area).asc_nulls_last())


def direction_totals(df: DataFrame, direction: str, volume: str, price: str) -> DataFrame:
    return df.groupBy(direction).agg(
        F.count("*").alias("total_bids"),
        F.round(F.sum(volume), 0).alias("total_volume_mw"),
        F.round(F.avg(price), 2).alias("avg_price"),
    )


def largest(df: DataFrame, columns: list[str], volume: str, ties: list[str], k: int = 20) -> DataFrame:
    """The ``k`` rows with the highest volume, as a top-k rather than a full sort."""
    order = [F.col(volume).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    return df.select(*dict.fromkeys([*columns, volume, *ties])).orderBy(*order).limit(k).select(*columns)


def negative_levels(df: DataFrame, price: str, currency: str, k: int = 100) -> DataFrame:
    """Distinct negative (price, currency) pairs, lowest first."""
    pairs = df.filter(F.col(price) < 0).select(price, currency).distinct()
    return pairs.orderBy(F.col(price).asc(), F.col(currency).asc_nulls_last()).limit(k)


def dwell_at_minimum(
    df: DataFrame,
    area: str,
    price: str,
    start: str,
    end: str,
    only_area: str | None = None,
    interval_minutes: int = INTERVAL_MINUTES,
) -> DataFrame:
    """How long each area stood at its own lowest price, counted in rows.

    Levels are aggregated first; the lowest level per area is then a second small
    aggregate over those, so the table is read once and no area is sorted."""
    rows = df.filter(F.col(price).isNotNull() & F.col(area).isNotNull())
    if only_area is not None:
        rows = rows.filter(F.col(area) == only_area)
    levels = rows.groupBy(area, price).agg(
        F.count("*").alias("n"), F.min(start).alias("first_seen"), F.max(end).alias("last_seen")
    )
    lowest = levels.groupBy(area).agg(
        F.min(F.struct(price, "n", "first_seen", "last_seen")).alias("level")
    )
    count = F.col("level.n")
    minutes = count * F.lit(interval_minutes)
    return lowest.select(
        area,
        F.col("level")[price].alias("price"),
        count.alias("intervals_count"),
        minutes.alias("total_minutes"),
        F.round(minutes.cast("double") / 60.0, 2).alias("total_hours"),
        F.col("level.first_seen").alias("first_seen"),
        F.col("level.last_seen").alias("last_seen"),
    )


def periods_covered(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, spells, seconds, first_seen, last_seen): the union of the half-open periods [start, end) of
    each group. Time that several periods cover counts once; periods that touch are one spell.

    Rows are dealt out by range of (keys, start), so a group of any size is spread over many tasks. A
    row adds what lies behind the largest end before it, and that end comes from the row's own range
    and from one row for each earlier range. Rows without a start or end, or of no length, are left out."""
    rows = df.where(F.col(start) < F.col(end)).groupBy(*keys, F.col(start).alias("_start")).agg(F.max(end).alias("_end"))
    group = rows.select(F.struct(*keys).alias("_group"), "_start", "_end")
    ranges = in_ranges(group, "_group", ["_start"])
    ends = ranges.groupBy("_group", "_block").agg(F.max("_end").alias("_end"))
    earlier = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = small_side(ends.select("_group", "_block", F.max("_end").over(earlier).alias("_carried")))
    inside = Window.partitionBy("_group", "_block").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    joined = match_keys(ranges.withColumn("_own", F.max("_end").over(inside)), carried, ["_group", "_block"])
    before = F.greatest("_own", "_carried")
    uncovered = F.timestamp_diff("MICROSECOND", F.greatest("_start", before), F.col("_end"))
    added = F.greatest(uncovered, F.lit(0).cast("long"))
    opens = (before.isNull() | (F.col("_start") > before)).cast("long")
    cut = joined.select("_group", "_start", "_end", added.alias("_added"), opens.alias("_opens"))
    return cut.groupBy("_group").agg(
        F.sum("_opens").alias("spells"), (F.sum("_added") / 1e6).alias("seconds"), F.min("_start").alias("first_seen"), F.max("_end").alias("last_seen")
    ).select("_group.*", "spells", "seconds", "first_seen", "last_seen")


def dwell_periods(df: DataFrame, area: str, price: str, start: str, end: str) -> DataFrame:
    """How long each area stood at its own lowest price, from the periods themselves: simultaneous bids
    count once, and a period counts as long as it is."""
    rows = df.where(F.col(price).isNotNull() & F.col(area).isNotNull())
    lowest = small_side(rows.groupBy(area).agg(F.min(price).alias("_lowest")))
    held = match_keys(rows, lowest, [area]).where(F.col(price) == F.col("_lowest"))
    found = periods_covered(held, [area, price], start, end)
    return found.select(
        area, price, "spells", F.round(F.col("seconds") / 60, 2).alias("total_minutes"), F.round(F.col("seconds") / 3600, 2).alias("total_hours"), "first_seen", "last_seen"
    )


def capacity_over_time(
    df: DataFrame,
    area: str,
    unit: list[str],
    fuel: str,
    capacity: str,
    status: str,
    valid_from: str,
    valid_to: str,
    commissioned: str = "COMMISSIONED",
) -> DataFrame:
    """(country, fuel_type, since, total_mw): installed capacity per fuel and area as a step function;
    each row holds until the next of its country and fuel.

    Validities become signed changes. A unit that is listed several times at once counts while at
    least one listing holds: changes of the number of its listings are added up, and only those from
    and to none change the capacity. Both running sums work in ranges, so neither a unit with very
    many listings nor a country with very many units is ever in one task."""
    at = lambda c: F.col(c).try_cast("timestamp_ntz")
    listed = df.where(F.col(fuel).isNotNull() & (F.col(capacity) > 0) & (F.col(status) == commissioned) & at(valid_from).isNotNull())
    listed = listed.where(at(valid_to).isNull() | (at(valid_to) > at(valid_from)))
    ends = F.array(F.struct(at(valid_from).alias("since"), F.lit(1).alias("change")), F.struct(at(valid_to).alias("since"), F.lit(-1).alias("change")))
    one = F.struct(F.col(area).alias("country"), F.col(fuel).alias("fuel_type"), F.col(capacity).alias("capacity"), *unit)
    changes = listed.select(one.alias("unit"), F.inline(ends)).where(F.col("since").isNotNull())
    changes = changes.groupBy("unit", "since").agg(F.sum("change").alias("change")).where("change <> 0")
    counted = running_total(changes, "unit", ["since"], "change", out="listings")
    step = F.when(F.col("listings") == F.col("change"), F.col("unit.capacity")).when(F.col("listings") == 0, -F.col("unit.capacity"))
    steps = counted.select(F.struct("unit.country", "unit.fuel_type").alias("fuels"), "since", step.alias("mw")).where(F.col("mw").isNotNull())
    steps = steps.groupBy("fuels", "since").agg(F.sum("mw").alias("mw")).where("mw <> 0")
    total = running_total(steps, "fuels", ["since"], "mw", out="total_mw")
    return total.select("fuels.country", "fuels.fuel_type", "since", "total_mw")


def level_frequency(df: DataFrame, area: str, only_area: str, price: str, start: str, k: int = 20) -> DataFrame:
    """How often each negative price level occurs in one area, lowest first."""
    rows = df.filter((F.col(area) == only_area) & (F.col(price) < 0))
    levels = rows.groupBy(F.col(price).alias("price")).agg(
        F.count("*").alias("frequency"), F.min(start).alias("sample_time")
    )
    return levels.orderBy("price").limit(k)


def dwell_at_level(
    df: DataFrame,
    area: str,
    price: str,
    start: str,
    level: float | None = None,
    only_area: str | None = None,
    interval_minutes: int = INTERVAL_MINUTES,
) -> DataFrame:
    """Hours at a price level from distinct interval starts, and rows per interval.

    Without ``level`` every (area, price) pair is reported."""
    rows = df if only_area is None else df.filter(F.col(area) == only_area)
    if level is not None:
        rows = rows.filter(F.col(price) == F.lit(float(level)))
    # One row per (area, price, start) first: the distinct count becomes a plain count.
    starts = rows.groupBy(area, price, start).agg(F.count("*").alias("n"))
    pairs = starts.groupBy(area, F.col(price).alias("price")).agg(
        F.count(start).alias("unique_intervals"), F.sum("n").alias("n")
    )
    return pairs.select(
        area,
        "price",
        "unique_intervals",
        F.round(interval_hours(F.col("unique_intervals"), interval_minutes), 2).alias("actual_hours_at_floor"),
        F.round(F.try_divide(F.col("n").cast("double"), F.col("unique_intervals")), 1).alias("bids_density"),
    )


def floor_total(
    df: DataFrame,
    area: str,
    only_area: str,
    price: str,
    start: str,
    level: float,
    interval_minutes: int = INTERVAL_MINUTES,
) -> DataFrame:
    """Distinct intervals of one area at one level, over everything (a missing start is one)."""
    rows = df.filter((F.col(area) == only_area) & (F.col(price) == F.lit(float(level))))
    return (
        rows.select(start)
        .distinct()
        .agg(F.count("*").alias("total_intervals"))
        .withColumn("real_hours_at_the_floor", interval_hours(F.col("total_intervals"), interval_minutes))
    )


def capacity_share(
    df: DataFrame,
    area: str,
    unit: list[str],
    fuel: str,
    capacity: str,
    status: str,
    valid_from: str,
    valid_to: str,
    instant: str,
    commissioned: str = "COMMISSIONED",
    top: int = 10,
) -> DataFrame:
    """Installed capacity per fuel and area at one instant: shares and rank.

    Units are listed once per generator, so identical unit rows collapse before the sum."""
    units = df.filter(
        F.col(fuel).isNotNull()
        & (F.col(capacity) > 0)
        & (F.col(status) == commissioned)
        & is_valid_at(instant, F.col(valid_from), F.col(valid_to))
    ).select(F.col(area).alias("country"), *unit, F.col(fuel).alias("fuel_type"), F.col(capacity).alias("capacity"))
    totals = units.distinct().groupBy("country", "fuel_type").agg(F.sum("capacity").alias("total_mw"))
    ranked = totals.select(
        "fuel_type",
        dense_rank_column("total_mw", "fuel_type").alias("rank_in_europe"),
        "country",
        F.round("total_mw", 0).alias("capacity_mw"),
        share_column("total_mw", "fuel_type").alias("%_of_EU_fuel"),
        share_column("total_mw", "country").alias("%_of_country_mix"),
    )
    return ranked.filter(F.col("rank_in_europe") <= top).orderBy("fuel_type", "rank_in_europe", "country")


def currency_range(df: DataFrame, currency: str, price: str) -> DataFrame:
    return df.groupBy(currency).agg(
        F.count("*").alias("records_count"),
        F.min(price).alias("min_raw_price"),
        F.max(price).alias("max_raw_price"),
    )


def average_price(
    df: DataFrame, zone: str, price: str, currency: str, rates: Mapping[str, float] = RATES
) -> DataFrame:
    """Average price per zone in one currency, dearest zone first."""
    converted = converted_price(F.col(price), F.col(currency), rates)
    averages = df.groupBy(F.col(zone).alias("bidding_zone")).agg(F.round(F.avg(converted), 2).alias("avg_price_eur"))
    return averages.orderBy(F.col("avg_price_eur").desc_nulls_last(), F.col("bidding_zone").asc_nulls_last())


def price_bins(
    df: DataFrame,
    zone: str,
    price: str | Column,
    currency: str | Column,
    rates: Mapping[str, float] = RATES,
    width: float = BIN_WIDTH,
) -> DataFrame:
    """Distribution of prices over bins per zone: share, cumulative share, smoothed count.

    The neighbours of a bin are the bins present; rows without a price form one bin,
    placed last. Windows run over bins, never over rows."""
    price = F.col(price) if isinstance(price, str) else price
    currency = F.col(currency) if isinstance(currency, str) else currency
    bins = df.groupBy(
        F.col(zone).alias("bidding_zone"),
        bin_floor(converted_price(price, currency, rates), width).alias("price_bin_eur"),
    ).agg(F.count("*").alias("hours_count"))
    return bin_shares(bins)


def bin_shares(bins: DataFrame) -> DataFrame:
    """Shares, running shares and smoothed counts of (bidding_zone, price_bin_eur, hours_count)."""
    at = ("hours_count", "bidding_zone", "price_bin_eur")
    return bins.select(
        "bidding_zone",
        "price_bin_eur",
        "hours_count",
        share_column(*at).alias("bin_share_pct"),
        cumulative_share_column(*at).alias("cumulative_share_pct"),
        centred_mean_column(*at).alias("smoothed_hours_count"),
    ).orderBy(F.col("bidding_zone").asc_nulls_last(), F.col("price_bin_eur").asc_nulls_last())


def price_window(
    df: DataFrame, zone: str, only_zone: str, instant: str, columns: list[str], start: str, end: str, local_zone: str
) -> DataFrame:
    """Time-ordered rows of one zone in a half-open window given in local time."""
    rows = df.filter((F.col(zone) == only_zone) & in_zoned_window(F.col(instant), start, end, local_zone))
    return rows.select(*columns).orderBy(*[F.col(c).asc_nulls_last() for c in columns])
