"""One key holds a third of all rows: joins are split at run time, windows stay balanced."""

import pytest
from pyspark.sql import functions as F

from gridlake.operators import quality as q
from gridlake.operators import relational as r
from gridlake.operators import windows as w

ROWS = 240_000

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
    # Else partitions below 1 MB, as all are here, are merged whatever size is advised, and into as few
    # as this session has cores: four. As many cores as partitions are taken to be there.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionNum": "16",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(w, "small_side", lambda df, _real=w.small_side: _real(df, -1))
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, ROWS, 1, 8).select("id", key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("load"))


def run(df):
    """Execute with every column in use; the row count and the final plan."""
    counted = df.agg(F.count("*"), F.bit_xor(F.xxhash64(*df.columns)))
    rows = counted.collect()[0][0]
    return rows, counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_outer_merge_splits_a_hot_key(spark, hot, no_broadcast):
    names = hot.select("key").distinct().withColumn("name", F.upper("key"))
    rows, plan = run(r.merge_outer(hot, names, ["key"]))
    assert rows == ROWS
    assert "skew=true" in plan


def test_share_splits_a_hot_key_beyond_broadcast(hot, no_broadcast):
    rows, plan = run(w.share_of_total(hot, "key", "id"))
    assert rows == ROWS
    assert "skew=true" in plan


def test_duplicate_members_split_a_hot_group(spark, hot, no_broadcast):
    body = F.when(F.col("key") == "hot", F.lit("same " * 30)).otherwise(F.repeat(F.concat("load", F.lit(" ")), 2))
    texts = hot.select("id", body.alias("text"))
    rows, plan = run(q.duplicate_members(texts, "id", "text"))
    assert rows == ROWS // 3
    assert "skew=true" in plan


def test_replacing_sources_splits_a_hot_source(hot, no_broadcast, monkeypatch):
    monkeypatch.setattr(r, "small_side", lambda df: df)
    batch = hot.filter("id < 100 AND key != 'hot'")
    rows, plan = run(r.replace_by_source(hot, batch, "key"))
    replaced = hot.join(batch.select("key").distinct(), "key", "left_semi").count()
    assert rows == ROWS - replaced + batch.count()
    assert "skew=true" in plan


@pytest.mark.parametrize("op", ["running", "centred", "ranked"])
@pytest.mark.parametrize("dense", [False, True], ids=["even", "one dense stretch"])
def test_window_work_is_spread(spark, hot, no_broadcast, op, dense):
    """No task of the whole run, windows included, reads more than a share of the hot key."""
    at = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000) if dense else F.col("id")
    frame = hot.withColumn("value", F.col("id") % 1000).withColumn("at", at)
    if op == "running":
        out, column = w.running_total(frame, "key", ["at", "id"], "value"), "running"
    elif op == "centred":
        out, column = w.centred_mean(frame, "key", ["at", "id"], "value"), "smoothed"
    else:
        out, column = w.with_dense_rank(frame, "key", "at"), "rank"
    # The computed column is used, so that its window stays in the plan; each task counts its rows.
    sizes = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum(column)).collect()
    assert sum(r.n for r in sizes) == ROWS
    assert max(r.n for r in sizes) < ROWS / 6


def test_the_windows_are_in_the_plan(hot, no_broadcast):
    frame = hot.withColumn("value", F.col("id") % 1000)
    for out in (w.running_total(frame, "key", ["id"], "value"), w.centred_mean(frame, "key", ["id"], "value"), w.with_dense_rank(frame, "key", "id")):
        assert "Window" in run(out)[1]
