"""Shares, ranks, running totals and moving means.

Two families:

* ``*_columns`` helpers return window Columns for frames that are already aggregated
  (one row per group and bin), where a partition is small by construction.
* The other functions take raw rows, where one key may hold a large part of the table.
  They never sort a whole key in one task: rows are dealt out by range of (key, order), which
  Spark measures, so that a dense stretch is cut as finely as it needs. What a range misses
  of its neighbours comes from one row for each key and range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridlake.functions.values import percent
from gridlake.session import cut_lineage, small_side


#: Ranges for each shuffle partition.
RANGES = 4


def _ordered(key: str, order: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())


def share_column(value: str, key: str, order: str | None = None, digits: int = 2) -> Column:
    """Share of the partition total. Naming the ``order`` of a sibling window lets both
    run in the same sorted pass."""
    spec = Window.partitionBy(key) if order is None else _ordered(key, order)
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return percent(F.col(value), F.sum(value).over(whole), digits)


def cumulative_share_column(value: str, key: str, order: str, digits: int = 2) -> Column:
    spec = _ordered(key, order)
    so_far = F.sum(value).over(spec.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.sum(value).over(spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return percent(so_far, whole, digits)


def centred_mean_column(value: str, key: str, order: str, digits: int = 1) -> Column:
    return F.round(F.avg(value).over(_ordered(key, order).rowsBetween(-1, 1)), digits)


def dense_rank_column(value: str, key: str) -> Column:
    spec = Window.partitionBy(key).orderBy(F.col(value).desc_nulls_last())
    return F.dense_rank().over(spec).cast("long")


def match_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the right keys are dropped.

    The null-safe keys also keep an aggregated right side from lending its partitioning to
    the join: both sides then get an exchange of their own, which is what adaptive
    execution needs to split a hot key."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def share_of_total(df: DataFrame, key: str, value: str, out: str = "share_pct", digits: int = 2) -> DataFrame:
    """Each row's share of its key's total, in percent."""
    totals = small_side(df.groupBy(key).agg(F.sum(value).alias("_total")))
    joined = match_keys(df, totals, [key])
    return joined.withColumn(out, percent(F.col(value), F.col("_total"), digits)).drop("_total")


def in_ranges(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows with ``_block``: the range of (key, order) they lie in, all ranges of about the same
    size. Materialised (a job when the plan is built), so that ranges stay what they are.

    There are several ranges for each shuffle partition: windows deal whole ranges out by hash, and
    many small ones even out where a few large ones would meet by chance."""
    ranges = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(ranges, key, *order).withColumn("_block", F.spark_partition_id()))


def dense_ranks(df: DataFrame, key: str, value: str, out: str = "rank") -> DataFrame:
    """``(key, value, rank)``: dense rank, highest value first, of each distinct value.

    Equal values are combined first, so a frequent one is one row; the distinct values are
    ranked range by range, and each range adds the number of values in the ranges above."""
    levels = in_ranges(df.select(key, value).distinct(), key, [value])
    sizes = levels.groupBy(key, "_block").agg(F.count("*").alias("_levels"))
    above = Window.partitionBy(key).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(key, "_block", F.coalesce(F.sum("_levels").over(above), F.lit(0)).alias("_above"))
    spec = Window.partitionBy(key, "_block").orderBy(F.col(value).desc_nulls_last())
    ranked = match_keys(levels.withColumn("_rank", F.dense_rank().over(spec)), small_side(offsets), [key, "_block"])
    return ranked.select(key, value, (F.col("_rank") + F.col("_above")).cast("long").alias(out))


def with_dense_rank(df: DataFrame, key: str, value: str, out: str = "rank") -> DataFrame:
    """Every row with the dense rank of its value inside its key: the distinct values are ranked
    and the rows joined to them, which adaptive execution can split at a frequent value."""
    return match_keys(df, dense_ranks(df, key, value, out), [key, value])


def dense_top_n(df: DataFrame, key: str, value: str, n: int, out: str = "rank") -> DataFrame:
    """All rows whose value is among the ``n`` highest distinct values of their key.

    The rank filter sits on distinct values, so each map task passes on at most ``n``
    values per key before anything is shuffled by key alone."""
    levels = df.select(key, value).distinct()
    top = levels.withColumn(out, dense_rank_column(value, key)).filter(F.col(out) <= n)
    return match_keys(df, small_side(top), [key, value])


def running_total(df: DataFrame, key: str, order: list[str], value: str, out: str = "running") -> DataFrame:
    """``sum(value)`` from the start of the key up to and including the row; ``order`` is unique."""
    rows = in_ranges(df, key, order)
    sums = rows.groupBy(key, "_block").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small_side(sums.select(key, "_block", F.sum("_sum").over(earlier).alias("_before")))
    inside = Window.partitionBy(key, "_block").orderBy(*order)
    local = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = match_keys(rows.withColumn("_local", local), offsets, [key, "_block"])
    # A NULL on one side is an empty sum; two NULLs mean no value has been seen yet.
    total = F.coalesce(F.col("_local") + F.col("_before"), F.col("_local"), F.col("_before"))
    return joined.withColumn(out, total).drop("_block", "_local", "_before")


def centred_mean(df: DataFrame, key: str, order: list[str], value: str, out: str = "smoothed") -> DataFrame:
    """Mean of the previous, current and next row of the key; ``order`` must be unique.

    Inside a range this is an ordinary frame. The first and last row of a range borrow
    their missing neighbour from the edge table of the adjacent ranges."""
    rows = in_ranges(df, key, order)
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    edges = rows.groupBy(key, "_block").agg(
        F.min_by(value, position).alias("_first"), F.max_by(value, position).alias("_last")
    )
    along = Window.partitionBy(key).orderBy("_block")
    borders = small_side(
        edges.select(
            key,
            "_block",
            F.lag("_last").over(along).alias("_prev"),
            F.lead("_first").over(along).alias("_next"),
        )
    )
    inside = Window.partitionBy(key, "_block").orderBy(*order)
    near = inside.rowsBetween(-1, 1)
    framed = (
        rows.withColumn("_sum", F.sum(value).over(near))
        .withColumn("_n", F.count(value).over(near))
        .withColumn("_starts", F.lag(F.lit(True)).over(inside).isNull())
        .withColumn("_ends", F.lead(F.lit(True)).over(inside).isNull())
    )
    joined = match_keys(framed, borders, [key, "_block"])
    left = F.when(F.col("_starts"), F.col("_prev"))
    right = F.when(F.col("_ends"), F.col("_next"))
    zero = F.lit(0)
    total = F.coalesce(F.col("_sum"), zero) + F.coalesce(left, zero) + F.coalesce(right, zero)
    count = F.col("_n") + left.isNotNull().cast("int") + right.isNotNull().cast("int")
    helpers = ["_block", "_sum", "_n", "_starts", "_ends", "_prev", "_next"]
    return joined.withColumn(out, F.try_divide(total.cast("double"), count)).drop(*helpers)
