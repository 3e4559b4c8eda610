import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridlake.operators import sketches as k


# --- distinct counts ------------------------------------------------------------------------


def test_sketches_are_kept_and_merged(spark, tmp_path):
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("area"),
        (F.col("id") % 10).alias("day"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 90_000).otherwise(F.col("id") % 30_000).alias("v"),
    )
    path = str(tmp_path / "kept")
    k.distinct_sketches(rows, ["area", "day"], "v").write.parquet(path)
    kept = spark.read.parquet(path)  # the rows are not needed any more
    early = k.united_sketches(kept.where("day < 5"), ["area"], out="early")
    late = k.united_sketches(kept.where("day >= 5"), ["area"], out="late")
    both = early.join(late, "area").select(
        "area", k.distinct_in("early").alias("early"), k.distinct_in("late").alias("late"),
        k.distinct_in(F.theta_union("early", "late")).alias("any"),
        k.distinct_in_both("early", "late").alias("both"), k.distinct_in_first_only("early", "late").alias("only"),
    )
    got = {r.area: r.asDict() for r in both.collect()}
    exact = {}
    for r in rows.groupBy("area", "v").agg(F.min("day").alias("lo"), F.max("day").alias("hi")).collect():
        e = exact.setdefault(r.area, dict(early=0, late=0, any=0, both=0, only=0))
        lo, hi = r.lo < 5, r.hi >= 5
        for name, holds in (("early", lo), ("late", hi), ("any", True), ("both", lo and hi), ("only", lo and not hi)):
            e[name] += holds
    for area, e in exact.items():
        assert e["any"] > 10_000
        for name, n in e.items():
            assert abs(got[area][name] - n) <= 5 * e["any"] / math.sqrt(1 << k.THETA_LOG), (area, name)


def test_few_values_are_counted_exactly(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None)], "g string, v long")
    got = {r.g: r.n for r in k.distinct_sketches(df, ["g"], "v").select("g", k.distinct_in("sketch").alias("n")).collect()}
    assert got == {"a": 2, "b": 0}


# --- profiles -------------------------------------------------------------------------------


def test_profile(spark):
    draw = random.Random(4)
    values = [draw.gauss(0, 100) for _ in range(20_000)]
    rows = [(i % 1000, v if i % 10 else None, f"t{i % 7}" if i % 5 else None, b"x") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n int, x double, t string, b binary").repartition(7)
    got = {r.summary: r for r in k.profile(df, shares=(0.1, 0.5, 0.999)).collect()}
    assert list(got) == ["count", "mean", "stddev", "min", "10%", "50%", "99.9%", "max"]
    assert got["count"].asDict() == {"summary": "count", "n": "20000", "x": "18000", "t": "16000"}
    assert (got["min"].t, got["max"].t, got["mean"].t, got["50%"].t) == ("t0", "t6", None, None)
    plain = {r.summary: r for r in df.select("n", "x").summary("mean", "stddev", "min", "max").collect()}
    for label, r in plain.items():
        assert float(got[label].x) == pytest.approx(float(r.x)) and float(got[label].n) == pytest.approx(float(r.n))
    present = sorted(v for i, v in enumerate(values) if i % 10)
    for label, share in (("10%", 0.1), ("50%", 0.5), ("99.9%", 0.999)):
        rank = sum(v <= float(got[label].x) for v in present) / len(present)
        assert abs(rank - share) <= 0.01
        assert abs(float(got[label].n) / 1000 - share) <= 0.011


def test_profile_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "n int, x double, t string")
    got = {r.summary: tuple(r)[1:] for r in k.profile(empty).collect()}
    assert got["count"] == ("0", "0", "0") and all(v == (None, None, None) for s, v in got.items() if s != "count")
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert {r.summary: r.x for r in k.profile(nan).collect()}["50%"] == "1.0"


def test_quantile_sketches_merge(spark):
    df = spark.range(100_000).select((F.col("id") % 10).alias("g"), (F.col("id") * 7919 % 100_003).alias("v"))
    parts = df.groupBy("g").agg(k.quantile_sketch(F.col("v"), df.schema["v"].dataType).alias("s"))
    middle = parts.agg(F.kll_merge_agg_bigint("s").alias("s")).select(k.quantile_of(F.col("s"), df.schema["v"].dataType, 0.5)).first()[0]
    assert abs(df.where(F.col("v") <= middle).count() / 100_000 - 0.5) <= 0.01


# --- exact sums -----------------------------------------------------------------------------


def cancelling(n, seed):
    draw = random.Random(seed)
    values = [draw.choice([1e16, -1e16, 1.0, 0.1, 1e-300, -3e200, 3e200, 5e-324, 1.7e308, -1.7e308, 2.0**31, 2.0**32, -(2.0**-32)]) for _ in range(n)]
    values += [draw.uniform(-1, 1) * 10.0 ** draw.randint(-30, 30) for _ in range(n)]
    values += [draw.uniform(-1, 1) * 2.0 ** draw.randint(-1070, 1000) for _ in range(n)]
    return values


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_sums_do_not_depend_on_order(spark, parts):
    groups = {g: cancelling(60, g) for g in range(5)}
    rows = [(g, v) for g, values in groups.items() for v in values] + [(None, 0.1), (None, 0.2), (9, None)]
    df = spark.createDataFrame(rows, "g long, v double").repartition(parts)
    got = {r.g: (r.total, r.mean) for r in k.exact_sums(df, ["g"], "v", mean="mean").collect()}
    for g, values in groups.items():
        exact = sum(map(Fraction, values))
        assert got[g] == (k.rounded(exact), k.rounded(exact / len(values)))
    assert got[None] == (math.fsum([0.1, 0.2]), math.fsum([0.1, 0.2]) / 2) and got[9] == (None, None)


def test_sums_of_special_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", inf), ("a", 1.0), ("b", inf), ("b", -inf), ("c", nan), ("d", -inf), ("e", 1.7e308), ("e", 1.7e308), ("f", -0.0), ("f", 0.0)]
    df = spark.createDataFrame(rows, "a string, v double")
    got = {r.a: r.total for r in k.exact_sums(df, ["a"], "v").collect()}
    assert got["a"] == inf and math.isnan(got["b"]) and math.isnan(got["c"]) and got["d"] == -inf and got["e"] == inf and got["f"] == 0.0


def test_sum_without_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "v double")
    assert k.exact_sums(df, [], "v").first().total == math.fsum([0.1] * 10)
    assert k.exact_sums(df.limit(0), ["v"], "v").collect() == []


def test_a_group_sends_few_rows(spark):
    df = spark.range(50_000).select(F.concat(F.lit("hot"), F.col("id") % 1).alias("g"), (F.col("id") * 0.1).alias("v")).repartition(16)
    plan = k.exact_sums(df, ["g"], "v")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning(k0") :]
    assert "partial_sum" in below and "RoundRobin" in below and "collect_list" not in below
