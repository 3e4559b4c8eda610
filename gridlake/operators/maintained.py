"""Grouped reports that follow a table of replaceable sources.

Partial aggregates are kept per source, as a versioned table beside the one they come from. When
sources are replaced, added or emptied, only their rows are read: their partials are withdrawn and the
new ones put in their place, in one switch. The report is the merge of all partials.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.values import bin_floor, converted_price
from gridlake.operators.market import BIN_WIDTH, RATES, bin_shares
from gridlake.plans.versions import RUN_COLUMN, VersionedTable
from gridlake.sources.files import SOURCE_COLUMN

#: How partials of each kind are merged. A mean is a sum and a count.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    """A mergeable aggregate: its name, kind and input (rows are counted if it is None)."""

    name: str
    kind: str
    value: Column | None = None

    def partial(self) -> Column:
        made = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.kind]
        return made(F.lit(1) if self.value is None else self.value).alias(self.name)

    def merged(self) -> Column:
        return MERGES[self.kind](self.name).alias(self.name)


@dataclass
class Maintained:
    """Partials of ``rows`` (a versioned table) by ``keys``, kept in the versioned table ``partials``."""

    rows: VersionedTable
    partials: VersionedTable
    keys: Mapping[str, Column]
    measures: Sequence[Measure]
    last_changed: list[str] = field(default_factory=list)

    def changed(self) -> DataFrame:
        """(source, rows, run) of the sources whose rows are not those the partials were made of."""
        now = self.rows.landed().select(SOURCE_COLUMN, "rows", "run")
        if not self.partials.exists(self.partials.ledger):
            return now
        return now.join(self.partials.landed().select(SOURCE_COLUMN, "run"), [SOURCE_COLUMN, "run"], "left_anti").select(*now.columns)

    def refresh(self) -> list[str]:
        """Bring the partials up to date; the sources that were read. A second call reads nothing."""
        self.partials.repair()
        entries = self.changed().collect()  # names only
        self.last_changed = sorted(r[SOURCE_COLUMN] for r in entries)
        if not entries:
            return []
        spark = self.rows.spark
        delivered = spark.createDataFrame(entries, f"{SOURCE_COLUMN} STRING, rows BIGINT, run STRING")
        filled = [r[SOURCE_COLUMN] for r in entries if r["rows"]]
        batch = None
        if filled:
            rows = spark.table(self.rows.view).where(F.col(SOURCE_COLUMN).isin(filled))
            grouped = rows.groupBy(SOURCE_COLUMN, *[c.alias(k) for k, c in self.keys.items()])
            runs = delivered.select(SOURCE_COLUMN, F.col("run").alias(RUN_COLUMN))
            batch = grouped.agg(*[m.partial() for m in self.measures]).join(runs, SOURCE_COLUMN)
        self.partials.publish(batch, delivered)
        return self.last_changed

    def report(self) -> DataFrame:
        """(keys, measures) over all sources. Reads partials alone."""
        kept = self.rows.spark.table(self.partials.view)
        return kept.groupBy(*self.keys).agg(*[m.merged() for m in self.measures])


def price_stats(rows: VersionedTable, partials: VersionedTable, area: str, price: str) -> Maintained:
    """Average, range and count per area over rows that have a price."""
    return Maintained(rows, partials, {"area": F.col(area)}, [
        Measure("bid_count", "count", F.col(price)), Measure("total", "sum", F.col(price)),
        Measure("min_price", "min", F.col(price)), Measure("max_price", "max", F.col(price)),
    ])


def price_stats_report(stats: Maintained) -> DataFrame:
    merged = stats.report().where("bid_count > 0")
    out = merged.select("area", F.round(F.col("total") / F.col("bid_count"), 2).alias("avg_price"), "min_price", "max_price", "bid_count")
    return out.orderBy(F.desc("avg_price"), F.col("area").asc_nulls_last())


def direction_totals(rows: VersionedTable, partials: VersionedTable, direction: str, volume: str, price: str) -> Maintained:
    return Maintained(rows, partials, {"direction": F.col(direction)}, [
        Measure("total_bids", "count"), Measure("volume", "sum", F.col(volume)),
        Measure("prices", "count", F.col(price)), Measure("price", "sum", F.col(price)),
    ])


def direction_totals_report(totals: Maintained) -> DataFrame:
    return totals.report().select(
        "direction", "total_bids", F.round("volume", 0).alias("total_volume_mw"), F.round(F.try_divide("price", "prices"), 2).alias("avg_price")
    )


def price_bins(
    rows: VersionedTable, partials: VersionedTable, zone: str, price: str, currency: str, rates: Mapping[str, float] = RATES, width: float = BIN_WIDTH
) -> Maintained:
    """The counts behind the distribution of prices per zone."""
    bins = bin_floor(converted_price(F.col(price), F.col(currency), rates), width)
    return Maintained(rows, partials, {"bidding_zone": F.col(zone), "price_bin_eur": bins}, [Measure("hours_count", "count")])


def price_bins_report(bins: Maintained) -> DataFrame:
    return bin_shares(bins.report())
