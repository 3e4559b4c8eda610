import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlake.operators import market as m


def at(minutes):
    return dt.datetime(2026, 5, 15) + dt.timedelta(minutes=minutes)


BIDS = [
    # area code, area, price, volume, direction, currency, start (in quarter hours)
    ("Z1", "DE-LU", -15000.0, 10.0, "Down", "EUR", 0),
    ("Z1", "DE-LU", -15000.0, 20.0, "Down", "EUR", 0),
    ("Z1", "DE-LU", -15000.0, 5.0, "Down", "EUR", 3),
    ("Z1", "DE-LU", -20.0, 50.0, "Down", "EUR", 1),
    ("Z1", "DE-LU", -20.0, 50.0, "Up", "EUR", 2),
    ("Z1", "DE-LU", None, 7.0, "Up", "EUR", 4),
    ("Z2", "FR", 30.0, 1.0, "Up", "EUR", 0),
    ("Z2", "FR", 40.0, 2.0, "Up", "EUR", 1),
    ("Z3", "PL", -20.0, 3.4, "Down", "PLN", 0),
    ("Z4", "UA", None, None, None, "UAH", 0),
]


@pytest.fixture(scope="module")
def bids(spark):
    rows = [(i, *r[:6], at(15 * r[6]), at(15 * r[6] + 15)) for i, r in enumerate(BIDS)]
    return spark.createDataFrame(
        rows,
        "id long, areacode string, area string, price double, volume double, direction string, currency string, "
        "start timestamp_ntz, stop timestamp_ntz",
    ).cache()


def collect(df):
    return [tuple(r) for r in df.collect()]


def test_most_frequent(bids):
    assert collect(m.most_frequent(bids, "areacode", 3)) == [("Z1", 6), ("Z2", 2), ("Z3", 1)]


def test_price_stats(bids):
    assert collect(m.price_stats(bids, "area", "price")) == [
        ("FR", 35.0, 30.0, 40.0, 2),
        ("PL", -20.0, -20.0, -20.0, 1),
        ("DE-LU", -9008.0, -15000.0, -20.0, 5),
    ]


def test_direction_totals(bids):
    got = {r[0]: r[1:] for r in collect(m.direction_totals(bids, "direction", "volume", "price"))}
    assert got == {"Down": (5, 88.0, -9008.0), "Up": (4, 60.0, 16.67), None: (1, None, None)}


def test_largest_breaks_ties_by_key(bids):
    got = collect(m.largest(bids, ["id", "volume"], "volume", ["id"], 3))
    assert got == [(3, 50.0), (4, 50.0), (1, 20.0)]


def test_negative_levels(bids):
    got = collect(m.negative_levels(bids, "price", "currency"))
    assert got == [(-15000.0, "EUR"), (-20.0, "EUR"), (-20.0, "PLN")]


def test_dwell_counts_rows_at_each_areas_minimum(bids):
    got = {r[0]: r[1:] for r in collect(m.dwell_at_minimum(bids, "area", "price", "start", "stop"))}
    assert got["DE-LU"] == (-15000.0, 3, 45, 0.75, at(0), at(60))
    assert got["FR"] == (30.0, 1, 15, 0.25, at(0), at(15))
    assert "UA" not in got
    one = m.dwell_at_minimum(bids, "area", "price", "start", "stop", only_area="DE-LU")
    assert collect(one) == [("DE-LU", *got["DE-LU"])]


def test_level_frequency(bids):
    got = collect(m.level_frequency(bids, "area", "DE-LU", "price", "start"))
    assert got == [(-15000.0, 3, at(0)), (-20.0, 2, at(15))]


def test_dwell_at_level_uses_distinct_starts(bids):
    got = collect(m.dwell_at_level(bids, "area", "price", "start", level=-15000, only_area="DE-LU"))
    assert got == [("DE-LU", -15000.0, 2, 0.5, 1.5)]
    everywhere = {r[:2]: r[2:] for r in collect(m.dwell_at_level(bids, "area", "price", "start"))}
    assert everywhere[("DE-LU", -15000.0)] == (2, 0.5, 1.5)
    assert everywhere[("UA", None)] == (1, 0.25, 1.0)


def test_interval_length_is_a_parameter(bids):
    got = collect(m.dwell_at_level(bids, "area", "price", "start", -15000, "DE-LU", interval_minutes=60))
    assert got[0][3] == 2.0


def test_floor_total_counts_a_missing_start_once(spark, bids):
    assert collect(m.floor_total(bids, "area", "DE-LU", "price", "start", -15000)) == [(2, 0.5)]
    gaps = bids.withColumn("start", F.when(F.col("id") > 0, F.col("start")))
    assert collect(m.floor_total(gaps, "area", "DE-LU", "price", "start", -15000)) == [(3, 0.75)]
    with_null = m.dwell_at_level(gaps, "area", "price", "start", -15000, "DE-LU")
    assert collect(with_null)[0][2:4] == (2, 0.5)
    assert collect(m.floor_total(bids, "area", "none", "price", "start", -15000)) == [(0, 0.0)]


UNITS = [
    # area, unit, fuel, capacity, status, from, to
    ("DE", "U1", "Gas", 100.0, "COMMISSIONED", "2020-01-01", None),
    ("DE", "U1", "Gas", 100.0, "COMMISSIONED", "2021-01-01", None),  # second generator, same unit
    ("DE", "U2", "Gas", 50.0, "COMMISSIONED", "2020-01-01", "2026-05-17 00:00:00"),  # ends at the instant
    ("DE", "U3", "Gas", 50.0, "COMMISSIONED", "2020-01-01", "2026-05-17 00:00:01"),
    ("DE", "U4", "Gas", 25.0, "COMMISSIONED", "2027-01-01", None),  # not yet
    ("DE", "U5", "Gas", 0.0, "COMMISSIONED", "2020-01-01", None),
    ("DE", "U6", None, 10.0, "COMMISSIONED", "2020-01-01", None),
    ("DE", "U7", "Gas", 10.0, "DECOMMISSIONED", "2020-01-01", None),
    ("FR", "U8", "Gas", 150.0, "COMMISSIONED", "2020-01-01", None),
    ("FR", "U9", "Nuclear", 450.0, "COMMISSIONED", "2020-01-01", None),
    ("IT", "U10", "Gas", 20.0, "COMMISSIONED", "2020-01-01", None),
    ("IT", "U10", "Gas", 30.0, "COMMISSIONED", "2020-01-01", None),  # two capacities count twice
]


def share(df, **kw):
    args = ("area", ["unit"], "fuel", "capacity", "status", "valid_from", "valid_to", "2026-05-17 00:00:00")
    return collect(m.capacity_share(df, *args, **kw))


UNIT_SCHEMA = "area string, unit string, fuel string, capacity double, status string, valid_from string, valid_to string"


def test_capacity_share(spark):
    assert share(spark.createDataFrame(UNITS, UNIT_SCHEMA)) == [
        ("Gas", 1, "DE", 150.0, 42.86, 100.0),
        ("Gas", 1, "FR", 150.0, 42.86, 25.0),
        ("Gas", 2, "IT", 50.0, 14.29, 100.0),
        ("Nuclear", 1, "FR", 450.0, 100.0, 75.0),
    ]


def test_capacity_share_keeps_ten_ranks_with_ties(spark):
    rows = [(f"A{i}", f"U{i}", "Wind", float(100 - i), "COMMISSIONED", "2020-01-01", None) for i in range(14)]
    rows.append(("B", "UB", "Wind", 91.0, "COMMISSIONED", "2020-01-01", None))
    got = share(spark.createDataFrame(rows, UNIT_SCHEMA))
    assert len(got) == 11
    assert [r[1] for r in got][-2:] == [10, 10]


PRICES = [
    ("DE", 12.0, "EUR"), ("DE", 10.0, "EUR"), ("DE", 45.0, "PLN"), ("DE", -0.5, "EUR"), ("DE", None, "EUR"),
    ("UA", 1000.0, "UAH"), ("UA", 1000.0, None),
]


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame(PRICES, "zone string, price double, currency string").cache()


def test_currency_range_groups_the_missing_currency(prices):
    got = {r[0]: r[1:] for r in collect(m.currency_range(prices, "currency", "price"))}
    assert got == {"EUR": (4, -0.5, 12.0), "PLN": (1, 45.0, 45.0), "UAH": (1, 1000.0, 1000.0), None: (1, 1000.0, 1000.0)}


def test_average_price(prices):
    assert collect(m.average_price(prices, "zone", "price", "currency")) == [("UA", 511.5), ("DE", 16.63)]
    assert collect(m.average_price(prices, "zone", "price", "currency", rates={"PLN": 0.2}))[1] == ("DE", 7.63)


def test_price_bins(prices):
    got = [r for r in collect(m.price_bins(prices, "zone", "price", "currency")) if r[0] == "DE"]
    assert got == [
        ("DE", -10, 1, 20.0, 20.0, 1.5),
        ("DE", 10, 2, 40.0, 60.0, 1.3),
        ("DE", 40, 1, 20.0, 80.0, 1.3),
        ("DE", None, 1, 20.0, 100.0, 1.0),
    ]


def test_price_window(spark):
    rows = [("BE", at(60 * h), float(h)) for h in range(-30, 60)] + [("FR", at(0), 1.0)]
    df = spark.createDataFrame(rows, "zone string, t timestamp_ntz, p double")
    got = collect(m.price_window(df, "zone", "BE", "t", ["t", "p"], "2026-05-15", "2026-05-17", "Europe/Brussels"))
    assert [p for _, p in got] == [float(h) for h in range(-2, 46)]
