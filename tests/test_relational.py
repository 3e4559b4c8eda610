import pytest
from pyspark.sql import functions as F

from gridlake.operators import relational as r


@pytest.mark.parametrize("unique_keys", [True, False])
def test_merge_outer_of_the_walkthrough_pair(spark, rows, unique_keys):
    left = spark.createDataFrame(
        [(20000101, 1, 1.0), (20000101, 2, 2.0), (20000102, 1, 3.0), (20000102, 2, 4.0)], "time int, id int, v1 double"
    )
    right = spark.createDataFrame([(20000101, 1, "x"), (20000101, 2, "y")], "time int, id int, v2 string")
    merged = r.merge_outer(left, right, ["time", "id"], unique_keys)
    assert merged.dtypes == [("time", "int"), ("id", "int"), ("v1", "double"), ("v2", "string")]
    assert rows(merged) == [
        (20000101, 1, 1.0, "x"), (20000101, 2, 2.0, "y"), (20000102, 1, 3.0, None), (20000102, 2, 4.0, None),
    ]


@pytest.mark.parametrize("unique_keys", [True, False])
def test_merge_outer_keeps_both_sides_and_matches_null_keys(spark, rows, unique_keys):
    left = spark.createDataFrame([(1, "l1"), (None, "ln")], "k int, a string")
    right = spark.createDataFrame([(2, "r2"), (None, "rn")], "k int, b string")
    assert rows(r.merge_outer(left, right, ["k"], unique_keys)) == [(1, "l1", None), (2, None, "r2"), (None, "ln", "rn")]


def test_merge_outer_pairs_repeated_keys(spark, rows):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("l", -1)], "k string, a int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("r", 3)], "k string, b int")
    got = rows(r.merge_outer(left, right, ["k"]))
    assert got == sorted([("hot", i, b) for i in range(50) for b in (1, 2)]) + [("l", -1, None), ("r", None, 3)]


def test_latest_snapshot(spark, rows):
    files = spark.createDataFrame(
        [("F", "2026_04.csv", 1), ("F", "2026_05.csv", 2), ("F", "2026_05.csv", 3), ("G", "b.csv", 4), ("G", "a.csv", 5)],
        "folder string, file string, v int",
    )
    assert [x[2] for x in rows(r.latest_snapshot(files, "folder", "file"))] == [2, 3, 4]


def test_set_difference_both_ways(spark, rows):
    left = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "n string")
    right = spark.createDataFrame([("b",), ("c",), ("c",)], "n string")
    assert rows(r.set_difference(left, right, "n")) == [("a", "missing"), ("c", "extra"), (None, "missing")]


def test_replace_by_source_touches_its_sources_only(spark, rows):
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "s string, v int")
    batch = spark.createDataFrame([("a", 10)], "s string, v int")
    once = r.replace_by_source(target, batch, "s")
    assert rows(once) == [("a", 10), ("b", 3), (None, 4)]
    assert rows(r.replace_by_source(once, batch, "s")) == rows(once)


def test_pending_sources(spark, rows):
    found = spark.createDataFrame([("a",), ("b",), ("b",)], "s string")
    ledger = spark.createDataFrame([("a",), ("z",)], "s string")
    assert rows(r.pending_sources(found, ledger, "s")) == [("b",), ("b",)]
    assert rows(r.pending_sources(found, ledger, "s", force=True)) == [("a",), ("b",), ("b",)]


def test_concatenate_fills_absent_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert rows(r.concatenate(a, b)) == [(1, "x", None), (2, None, "y")]


def test_head_with_remainder(spark):
    names = spark.createDataFrame([(f"n{i:02d}",) for i in range(8)], "name string")
    head = r.head_with_remainder(names, "name").collect()
    assert [tuple(x) for x in head] == [(f"n{i:02d}", 3) for i in range(5)]
    last = r.head_with_remainder(names, "name", 2, descending=True).collect()
    assert [tuple(x) for x in last] == [("n07", 6), ("n06", 6)]
    few = r.head_with_remainder(names.limit(3), "name").collect()
    assert {x.remaining for x in few} == {0}


def test_valid_at(spark, rows):
    df = spark.createDataFrame([(1, "2020-01-01", None), (2, "2030-01-01", None)], "k int, f string, t string")
    assert [x[0] for x in rows(r.valid_at(df, "2026-01-01", "f", "t"))] == [1]


def test_max_by_gives_the_latest_name(spark):
    df = spark.createDataFrame([("a", 1), ("c", 3), ("b", 2)], "f string, t int")
    assert df.agg(F.max_by("f", "t")).first()[0] == "c"
