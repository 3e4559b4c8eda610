"""Set, merge and snapshot operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.values import is_valid_at
from gridlake.operators.windows import match_keys
from gridlake.session import small_side


def valid_at(df: DataFrame, instant: str, valid_from: str, valid_to: str) -> DataFrame:
    """Rows in force at an instant: from <= instant, and no end or an end after it."""
    return df.filter(is_valid_at(instant, F.col(valid_from), F.col(valid_to)))


def merge_outer(left: DataFrame, right: DataFrame, on: list[str], unique_keys: bool = False) -> DataFrame:
    """Full outer merge on shared columns, NULL keys matching NULL keys.

    Adaptive execution cannot split a hot key of a full outer join. Unless the keys are
    known to be unique on each side, the merge is put together from a left outer join and
    one anti join against distinct keys, both of which it can split."""
    rest = [c for c in [*left.columns, *right.columns] if c not in on]
    if not unique_keys:
        with_left = match_keys(left, right, on, "left_outer")
        right_only = match_keys(right, left.select(*on).distinct(), on, "left_anti")
        return concatenate(with_left, right_only).select(*on, *rest)
    names = {c: f"_right_{c}" for c in on}
    other = right.withColumnsRenamed(names)
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()])
    joined = left.join(other, condition, "full_outer")
    keys = [F.coalesce(F.col(k), F.col(r)).alias(k) for k, r in names.items()]
    return joined.select(*keys, *rest)


def latest_snapshot(df: DataFrame, group: str, version: str) -> DataFrame:
    """Rows that belong to the greatest version (file name) of their group."""
    # Distinct names first: a text maximum over raw rows would have to sort them.
    names = df.select(group, version).distinct()
    latest = names.groupBy(group).agg(F.max(version).alias(version))
    return match_keys(df, small_side(latest), [group, version], "left_semi")


def set_difference(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Distinct names found on one side only, labelled ``missing`` (not on the right) or
    ``extra`` (not on the left). Both directions come from one combining aggregate."""

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        return df.select(name, F.lit(is_left).alias("_l"), F.lit(not is_left).alias("_r"))

    seen = side(left, True).unionByName(side(right, False))
    flags = seen.groupBy(name).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    label = F.when(F.col("_l"), "missing").otherwise("extra")
    return flags.filter(F.col("_l") != F.col("_r")).select(name, label.alias("side"))


def concatenate(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def replace_by_source(target: DataFrame, batch: DataFrame, source: str) -> DataFrame:
    """Target after the batch took the place of all earlier rows of its sources."""
    sources = batch.select(source).distinct()
    return match_keys(target, small_side(sources), [source], "left_anti").unionByName(batch)


def pending_sources(found: DataFrame, ledger: DataFrame, source: str, force: bool = False) -> DataFrame:
    """Rows of ``found`` whose source the ledger does not hold; all of them when forced."""
    return found if force else found.join(ledger.select(source).distinct(), source, "left_anti")


def head_with_remainder(df: DataFrame, name: str, n: int = 5, descending: bool = False) -> DataFrame:
    """The first ``n`` names in order, each with the number of names left out."""
    order = F.col(name).desc() if descending else F.col(name).asc()
    names = df.select(name).filter(F.col(name).isNotNull())
    total = names.agg(F.count("*").alias("n")).scalar()
    return names.orderBy(order).limit(n).withColumn("remaining", F.greatest(total - F.lit(n), F.lit(0).cast("long")))
