import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.testing.utils import assertDataFrameEqual, assertSchemaEqual

from gridlake.functions import headers as h
from gridlake.functions import values as v

HEADERS = {
    "Price[Currency/MWh]": "price_currency_mwh",
    "Volume[MW]": "volume_mw",
    "DateTime(UTC)": "datetime_utc",
    "ProductionUnitInstalledCapacity(MW)": "productionunitinstalledcapacity_mw",
    "AreaDisplayName": "areadisplayname",
    "Area Code": "area_code",
    "Share%.a-b,c": "share%.a-b,c",
}


@pytest.mark.parametrize(("raw", "clean"), HEADERS.items())
def test_header_rule(raw, clean):
    assert h.normalise_name(raw) == clean


def test_header_rule_on_data(spark):
    df = spark.createDataFrame(list(HEADERS.items()), "raw string, clean string")
    assert df.filter(h.normalise_name_column(F.col("raw")) != F.col("clean")).count() == 0


def test_columns_are_renamed_in_place(spark):
    df = spark.createDataFrame([(1.0, "x")], "`Price[Currency/MWh]` double, `Area Code` string")
    assert h.normalise_columns(df).columns == ["price_currency_mwh", "area_code"]


def test_header_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` int, A_B int")
    with pytest.raises(ValueError, match="a_b"):
        h.normalise_columns(df)


def test_text_coercion_keeps_null(spark):
    df = spark.createDataFrame(
        [(1, None, [1, 2], b"ab", dt.date(2024, 1, 1)), (2, "t", None, None, None)],
        "n int, s string, a array<int>, b binary, d date",
    )
    out = h.coerce_text(df)
    assert dict(out.dtypes) == {"n": "int", "s": "string", "a": "string", "b": "string", "d": "date"}
    assert [tuple(r) for r in out.orderBy("n").collect()] == [
        (1, None, "[1,2]", "ab", dt.date(2024, 1, 1)),
        (2, "t", None, None, None),
    ]


def test_conversion_touches_listed_currencies_only(spark):
    df = spark.createDataFrame([(100.0, "UAH"), (100.0, "EUR"), (100.0, "PLN"), (100.0, None), (None, "UAH")], "p double, c string")
    got = [r[0] for r in df.select(v.converted_price(F.col("p"), F.col("c"), {"UAH": 0.023})).collect()]
    assert got == [2.3, 100.0, 100.0, 100.0, None]


def test_bins(spark):
    df = spark.createDataFrame([(-0.1,), (-10.0,), (0.0,), (9.99,), (10.0,), (None,)], "p double")
    got = [r[0] for r in df.select(v.bin_floor(F.col("p"), 10.0)).collect()]
    assert got == [-10, -10, 0, 0, 10, None]


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(v.percent(F.col("a"), F.col("b"))).collect()] == [33.33, None]


VALIDITY = [
    ("2026-01-01", None, True),
    ("2026-05-17", None, True),
    ("2026-05-18", None, False),
    ("2026-01-01", "2026-05-17", False),
    ("2026-01-01", "2026-05-17 00:00:01", True),
    ("2026-01-01", "2026-05-16", False),
    ("not a date", None, False),
    ("2026-01-01", "not a date", False),
    (None, None, False),
]


def test_validity(spark):
    df = spark.createDataFrame(VALIDITY, "f string, t string, expected boolean")
    held = F.coalesce(v.is_valid_at("2026-05-17 00:00:00", F.col("f"), F.col("t")), F.lit(False))
    assert df.filter(held != F.col("expected")).count() == 0


def test_zoned_window_follows_summer_time(spark):
    start = dt.datetime(2024, 3, 30, 20)
    df = spark.createDataFrame([(start + dt.timedelta(hours=i),) for i in range(40)], "t timestamp_ntz")
    # 2024-03-31 has 23 hours in Brussels: 23:00 UTC the day before to 22:00 UTC.
    inside = df.filter(v.in_zoned_window(F.col("t"), "2024-03-31", "2024-04-01", "Europe/Brussels"))
    got = inside.agg(F.min("t"), F.max("t"), F.count("*")).first()
    assert tuple(got) == (dt.datetime(2024, 3, 30, 23), dt.datetime(2024, 3, 31, 21), 23)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_interval_start(spark, kind):
    at = [dt.datetime(2024, 1, 1, 10, 14, 59, 999999), dt.datetime(2024, 1, 1, 10, 15), dt.datetime(2024, 1, 1, 23, 59), None]
    df = spark.createDataFrame([(t,) for t in at], f"t {kind}")
    got = df.select(v.interval_start(F.col("t"), 15), v.interval_start(F.col("t"), 60 * 24)).collect()
    assert [r[0] for r in got] == [
        dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 15), dt.datetime(2024, 1, 1, 23, 45), None,
    ]
    assert [r[1] for r in got] == [dt.datetime(2024, 1, 1)] * 3 + [None]
    with pytest.raises(ValueError):
        v.interval_start(F.lit(None), 7)


def test_arrays_and_maps(spark):
    df = spark.createDataFrame(
        [([3, 8, 5, 2, 7, 12], {"north": "open", "süd": "shut", "東": "open"})],
        "a array<int>, m map<string,string>",
    )
    got = df.select(v.squares_of_evens(F.col("a")), v.entries_with_value(F.col("m"), "open")).first()
    assert got[0] == [64, 4, 144]
    assert got[1] == {"north": "open", "東": "open"}


def test_row_json_merges_extra_fields(spark):
    df = spark.createDataFrame([(1, "é")], "id int, message string")
    line = df.select(v.row_json(["id", "message"], level=F.lit("INFO"), id=F.col("id") + 1)).first()[0]
    assert json.loads(line) == {"message": "é", "level": "INFO", "id": 2}
    assert "\n" not in line


def test_spaces_collapse(spark):
    labels = [("unit   7", 400), ("block  B   upper", 12), ("plain", 1)]
    df = spark.createDataFrame([{"label": n, "mw": a} for n, a in labels])
    got = df.withColumn("label", v.collapse_spaces(F.col("label")))
    want = spark.createDataFrame([(a, " ".join(n.split())) for n, a in labels], ["mw", "label"])
    assertDataFrameEqual(got.select("mw", "label"), want)


def test_equality_helpers(spark):
    left = spark.createDataFrame([("north", 50.0), ("south", -7.5)], ["zone", "price"])
    right = spark.createDataFrame([("south", -7.6), ("north", 50.4)], ["zone", "price"])
    assertDataFrameEqual(left, right, rtol=2e-2)
    schema = T.StructType([T.StructField("levels", T.ArrayType(T.LongType()))])
    assertSchemaEqual(schema, spark.createDataFrame([], "levels array<bigint>").schema)


def test_local_rows(spark):
    import pandas as pd

    bids = [
        ("north", -12.25, 40, dt.date(2024, 7, 9), dt.datetime(2024, 7, 9, 22, 45)),
        ("south", 310.5, 7, dt.date(2024, 7, 10), dt.datetime(2024, 7, 10, 3, 15)),
    ]
    names = ["zone", "price", "volume", "day", "since"]
    frames = [
        spark.createDataFrame([Row(**dict(zip(names, bid))) for bid in bids]),
        spark.createDataFrame(bids, "zone string, price double, volume long, day date, since timestamp"),
        spark.createDataFrame(pd.DataFrame(bids, columns=names)),
        spark.createDataFrame([list(bid) for bid in bids], names),
    ]
    assert {str(f.dtypes) for f in frames} == {str(frames[0].dtypes)}
    assert all(f.collect() == frames[0].collect() for f in frames)
