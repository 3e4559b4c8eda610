"""Scalar, array, map and time expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def converted_price(price: Column, currency: Column, rates: Mapping[str, float]) -> Column:
    """Price in the reporting currency. Currencies without a rate pass unchanged."""
    out = price
    for code, rate in rates.items():
        out = F.when(currency == code, price * F.lit(float(rate))).otherwise(out)
    return out


def bin_floor(value: Column, width: float) -> Column:
    """Lower edge of the bin of ``value``, as an integer; NULL stays NULL."""
    step = F.lit(float(width))
    return (F.floor(value / step).cast("double") * step).cast("int")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole``; NULL where the whole is zero."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def interval_hours(intervals: Column, interval_minutes: int) -> Column:
    return intervals * F.lit(float(interval_minutes)) / F.lit(60.0)


def interval_start(instant: Column, interval_minutes: int) -> Column:
    """Start of the fixed-length delivery interval that holds ``instant``.

    Written as a subtraction because ``window`` would drop rows without a timestamp; it
    also keeps zone-less timestamps free of the session zone."""
    if 24 * 60 % interval_minutes:
        raise ValueError(f"{interval_minutes} minutes do not divide a day")
    past = (F.hour(instant) * 60 + F.minute(instant)) % interval_minutes
    seconds = F.extract(F.lit("SECOND"), instant)
    return instant - F.make_dt_interval(F.lit(0), F.lit(0), past, seconds)


def is_valid_at(instant: str, valid_from: Column, valid_to: Column) -> Column:
    """True where ``valid_from <= instant < valid_to``; an absent end is open.

    Text columns are parsed; unparsable text never matches."""
    at = F.lit(instant).cast("timestamp_ntz")
    return (valid_from.try_cast("timestamp_ntz") <= at) & (
        valid_to.isNull() | (valid_to.try_cast("timestamp_ntz") > at)
    )


def in_zoned_window(instant: Column, start: str, end: str, zone: str) -> Column:
    """Half-open window given in local time of ``zone``, over zone-less UTC instants."""

    def utc(text: str) -> Column:
        local = F.lit(text).cast("timestamp_ntz")
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)

    return (instant >= utc(start)) & (instant < utc(end))


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def squares_of_evens(values: Column) -> Column:
    return F.transform(F.filter(values, lambda x: x % 2 == 0), lambda x: x * x)


def entries_with_value(entries: Column, wanted: str) -> Column:
    return F.map_filter(entries, lambda _, v: v == wanted)


def row_json(columns: list[str], **extra: Column) -> Column:
    """One-line JSON of the named columns with extra fields merged in."""
    fields = [F.col(c) for c in columns if c not in extra]
    return F.to_json(F.struct(*fields, *[v.alias(k) for k, v in extra.items()]))
