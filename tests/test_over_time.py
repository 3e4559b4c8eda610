"""Periods, capacities over time, maintained reports and pairing of repeated rows, against plain versions."""

import datetime as dt
import random
import uuid
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridlake.operators import maintained
from gridlake.operators import market as m
from gridlake.operators import quality as q
from gridlake.operators.windows import in_ranges
from gridlake.plans import versions as v
from gridlake.sources.files import SOURCE_COLUMN

DAY = dt.datetime(2024, 3, 1)


def minutes(n):
    return DAY + dt.timedelta(minutes=n)


# --- periods --------------------------------------------------------------------------------


def covered(periods):
    spells, seconds, last = 0, 0.0, None
    for s, e in sorted(periods):
        spells += last is None or s > last
        seconds += max((e - (s if last is None else max(s, last))).total_seconds(), 0.0)
        last = e if last is None else max(last, e)
    return spells, seconds, min(s for s, _ in periods), last


def test_periods_like_brute_force(spark):
    draw = random.Random(3)
    rows = []
    for area in ["a", "b", None, "hot"]:
        for _ in range(1500 if area == "hot" else 40):
            s = draw.randint(0, 3000 if area != "hot" else 60_000)
            rows.append((area, minutes(s), minutes(s + draw.choice([0, 5, 15, 15, 30, 45, 600]))))
    rows += [("gap", None, minutes(1)), ("gap", minutes(1), None), ("gap", minutes(9), minutes(2)), ("long", minutes(0), minutes(90_000))]
    rows += [("long", minutes(i), minutes(i + 1)) for i in range(0, 900, 3)] + [("same", minutes(0), minutes(15))] * 500
    df = spark.createDataFrame(rows, "area string, s timestamp_ntz, e timestamp_ntz").repartition(6)
    got = {r.area: tuple(r)[1:] for r in m.periods_covered(df, ["area"], "s", "e").collect()}
    by = defaultdict(list)
    for area, s, e in rows:
        if s is not None and e is not None and s < e:
            by[area].append((s, e))
    assert got == {area: covered(p) for area, p in by.items()}


def test_dwell_counts_simultaneous_bids_once(spark):
    rows = [("x", -5.0, minutes(0), minutes(15))] * 3 + [("x", -5.0, minutes(15), minutes(45)), ("x", -5.0, minutes(60), minutes(75))]
    rows += [("x", 1.0, minutes(0), minutes(999)), ("y", 2.0, minutes(0), minutes(30)), (None, 0.0, minutes(0), minutes(1)), ("y", None, minutes(0), minutes(1))]
    df = spark.createDataFrame(rows, "area string, price double, s timestamp_ntz, e timestamp_ntz")
    got = {tuple(r) for r in m.dwell_periods(df, "area", "price", "s", "e").collect()}
    assert got == {("x", -5.0, 2, 60.0, 1.0, minutes(0), minutes(75)), ("y", 2.0, 1, 30.0, 0.5, minutes(0), minutes(30))}


def test_periods_of_a_hot_area_are_spread(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("area"), F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit(DAY).cast("timestamp_ntz")).alias("s"))
    df = df.withColumn("e", F.col("s") + F.expr("INTERVAL 90 SECOND"))
    assert [tuple(r)[1:3] for r in m.periods_covered(df, ["area"], "s", "e").collect()] == [(1, 40_000 * 60.0 + 30)]
    sizes = in_ranges(df.select(F.struct("area").alias("g"), "s"), "g", ["s"]).groupBy("_block").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 15_000


# --- capacity -------------------------------------------------------------------------------


def test_capacity_at_every_instant(spark):
    draw = random.Random(8)
    rows = []
    for _ in range(600):
        f = draw.randint(0, 40)
        t = draw.choice([None, f, f + draw.randint(1, 20)])
        rows.append((draw.choice("ab"), draw.randint(0, 6), draw.choice(["gas", "wind", None]), draw.choice([5, 10, 0, None]),
                     draw.choice(["COMMISSIONED", "COMMISSIONED", "DECOMMISSIONED"]), str(minutes(f)) if f else draw.choice([str(minutes(0)), None, "soon"]),
                     None if t is None else str(minutes(t))))
    rows += [("a", 1, "gas", 5, "COMMISSIONED", str(minutes(3)), str(minutes(4)))] * 300
    df = spark.createDataFrame(rows, "area string, unit int, fuel string, mw int, status string, f string, t string").repartition(5)
    steps = m.capacity_over_time(df, "area", ["unit"], "fuel", "mw", "status", "f", "t").collect()
    at = defaultdict(dict)
    for r in steps:
        assert r.since not in at[r.country, r.fuel_type]
        at[r.country, r.fuel_type][r.since] = r.total_mw
    for k in range(-1, 65):
        now = minutes(k)
        live = {r[:4] for r in rows if r[2] and r[3] and r[4] == "COMMISSIONED" and r[5] not in (None, "soon") and r[5] <= str(now) and (r[6] is None or r[6] > str(now))}
        want = Counter()
        for area, _, fuel, mw in live:
            want[area, fuel] += mw
        for key in [(a, f) for a in "ab" for f in ("gas", "wind")]:
            past = [s for s in at[key] if s <= now]
            assert (at[key][max(past)] if past else 0) == want[key], (key, k)


# --- maintained reports ---------------------------------------------------------------------


@pytest.fixture
def tables(spark, tmp_path):
    name = f"kept_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return [v.VersionedTable(spark, name, t, str(tmp_path / t)) for t in ("bids", "stats", "totals", "bins")]


def deliver(spark, table, files):
    """Replace the sources named by ``files``: name to rows (zone, price, currency, volume)."""
    rows = [(*r, name) for name, content in files.items() for r in content]
    batch = spark.createDataFrame(rows, f"zone string, price double, currency string, volume double, {SOURCE_COLUMN} string") if rows else None
    counts = spark.createDataFrame([(n, len(c)) for n, c in files.items()], f"{SOURCE_COLUMN} string, rows long")
    table.publish(batch, counts)


def test_reports_follow_replaced_sources(spark, tables):
    bids, *kept = tables
    draw = random.Random(6)
    some = lambda n: [(draw.choice("xyz"), draw.choice([None, -50.0, 7.5, 104.0]), draw.choice(["EUR", "UAH", None]), float(draw.randint(1, 9))) for _ in range(n)]
    stats = maintained.price_stats(bids, kept[0], "zone", "price")
    totals = maintained.direction_totals(bids, kept[1], "currency", "volume", "price")
    bins = maintained.price_bins(bids, kept[2], "zone", "price", "currency")

    def check(changed):
        for each in (stats, totals, bins):
            assert each.refresh() == sorted(changed) and each.refresh() == []
        rows = spark.table(bids.view)
        pairs = [
            (maintained.price_stats_report(stats), m.price_stats(rows, "zone", "price").withColumnRenamed("zone", "area")),
            (maintained.direction_totals_report(totals), m.direction_totals(rows, "currency", "volume", "price").withColumnRenamed("currency", "direction")),
            (maintained.price_bins_report(bins), m.price_bins(rows, "zone", "price", "currency")),
        ]
        for got, want in pairs:
            assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select(*got.columns).collect()))

    deliver(spark, bids, {f"{i}.csv": some(40) for i in range(6)})
    check([f"{i}.csv" for i in range(6)])
    deliver(spark, bids, {"1.csv": some(10), "4.csv": some(70)})  # fewer and more rows
    check(["1.csv", "4.csv"])
    deliver(spark, bids, {"2.csv": [], "9.csv": some(5)})  # one without rows, a new one
    check(["2.csv", "9.csv"])
    deliver(spark, bids, {f"{n}.csv": [] for n in (0, 1, 3, 4, 5)})
    check([f"{n}.csv" for n in (0, 1, 3, 4, 5)])
    assert maintained.price_bins_report(bins).agg(F.sum("hours_count")).first()[0] == 5


def test_only_changed_sources_are_read(spark, tables, monkeypatch):
    bids, _, _, kept = tables
    bins = maintained.price_bins(bids, kept, "zone", "price", "currency")
    deliver(spark, bids, {f"{i}.csv": [("x", float(i), "EUR", 1.0)] * 5 for i in range(5)})
    bins.refresh()
    deliver(spark, bids, {"3.csv": [("x", 99.0, "EUR", 1.0)]})
    read = []
    publish = kept.publish
    monkeypatch.setattr(kept, "publish", lambda batch, delivered: (read.append(batch), publish(batch, delivered)))
    assert bins.refresh() == ["3.csv"]
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "3.csv" in plan.split("PartitionFilters")[1]


def test_a_refresh_may_die(spark, tables, monkeypatch):
    bids, _, _, kept = tables
    bins = maintained.price_bins(bids, kept, "zone", "price", "currency")
    deliver(spark, bids, {"a.csv": [("x", 1.0, "EUR", 1.0)] * 4})
    bins.refresh()
    deliver(spark, bids, {"a.csv": [("x", 55.0, "EUR", 1.0)] * 3})
    monkeypatch.setattr(kept, "_point", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        bins.refresh()
    monkeypatch.undo()
    assert [tuple(r)[:3] for r in bins.report().collect()] == [("x", 0, 4)]
    assert bins.refresh() == ["a.csv"]
    assert [tuple(r)[:3] for r in bins.report().collect()] == [("x", 50, 3)]


# --- repeated rows --------------------------------------------------------------------------


def test_repeated_rows_are_paired(spark):
    left = [("k", "a", 1.0), ("k", "b", 2.0), ("k", "b", 3.0), ("m", "a", 1.0), ("m", "a", 1.0), (None, "z", 5.0), (None, "z", 6.0), ("n", "a", 1.0), ("n", "a", 2.0)]
    right = [("k", "b", 3.0000001), ("k", "a", 1.0000001), ("k", "b", 2.0), ("m", "a", 1.0), ("m", "a", 1.5), (None, "z", 5.0), (None, "y", 6.0), ("n", "a", 1.0)]
    schema = "k string, s string, x double"
    a, b = spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema).repartition(3)
    got = {tuple(r) for r in q.table_diff(a, b, ["k"], tolerance=1e-6, pair_repeated=True).collect()}
    # In the order of s, then x: (y 6, z 5) against (z 5, z 6) under the NULL key.
    other = {(None, "s", "z", "y", 2, 2), (None, "x", "5.0", "6.0", 2, 2), (None, "x", "6.0", "5.0", 2, 2)}
    assert got == other | {("m", "x", "1.0", "1.5", 2, 2), ("n", None, None, None, 2, 1)}
    plain = {tuple(r) for r in q.table_diff(a, b, ["k"], tolerance=1e-6).collect()}
    assert ("k", None, None, None, 3, 3) in plain


def test_a_key_that_repeats_very_often(spark):
    rows = spark.range(30_000).select(F.lit("hot").alias("k"), F.lit(1.0).alias("x"), (F.col("id") % 3).alias("n"))
    other = rows.withColumn("x", F.when(F.col("n") == 1, F.lit(1.0 + 1e-9)).otherwise(F.lit(1.0)))
    assert q.table_diff(rows, other, ["k"], tolerance=1e-6, pair_repeated=True).count() == 0
    changed = other.withColumn("x", F.when(F.col("n") == 2, 2.0).otherwise(F.col("x")))
    assert q.table_diff(rows, changed, ["k"], tolerance=1e-6, pair_repeated=True).count() == 10_000


def test_positions_number_each_key(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("v"))
    got = q.row_positions(df, ["k"], ["v"], "place").groupBy("k").agg(F.count("*").alias("n"), F.max("place").alias("top"), F.count_distinct("place").alias("d")).collect()
    assert all(r.n == r.top == r.d for r in got) and len(got) == 3
