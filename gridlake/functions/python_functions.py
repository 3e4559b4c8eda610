"""Vectorised Python functions, each next to its native twin elsewhere in the package.

They exist for callers who bring Python code; library operators stay on built-ins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.LongType())
def plus_one(values: pd.Series) -> pd.Series:
    return values + 1


@F.pandas_udf(T.IntegerType())
def add_one(values: pd.Series) -> pd.Series:
    return values + 1


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``add_one`` callable from SQL text and ``selectExpr``."""
    spark.udf.register("add_one", add_one)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema=None) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it may return any number of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        return map(fn, batches)

    return df.mapInPandas(run, schema=schema or df.schema)


def demean(value: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Per-group function that subtracts the group mean of one column."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return group.assign(**{value: group[value] - group[value].mean()})

    return run
