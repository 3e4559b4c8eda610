"""Header normalisation: raw publication headers to SQL-friendly names."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Opening marks, slash and space become "_", closing marks vanish.
_TO_UNDERSCORE = "[/( "
_DROPPED = "])"

_TABLE = str.maketrans(_TO_UNDERSCORE, "_" * len(_TO_UNDERSCORE), _DROPPED)


def normalise_name(name: str) -> str:
    """``Price[Currency/MWh]`` -> ``price_currency_mwh``."""
    return name.translate(_TABLE).lower()


def normalise_name_column(name: Column) -> Column:
    """The same rule for header names held as data."""
    return F.lower(F.translate(name, _TO_UNDERSCORE + _DROPPED, "_" * len(_TO_UNDERSCORE)))


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column; two headers that end up equal are an error."""
    names = [normalise_name(c) for c in df.columns]
    clashes = [n for n, count in Counter(names).items() if count > 1]
    if clashes:
        raise ValueError(f"headers collide after normalisation: {sorted(clashes)}")
    return df.toDF(*names)


_KEPT_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.StringType)


def coerce_text(df: DataFrame) -> DataFrame:
    """Cast every column without a scalar table type to string; NULL stays NULL.
    Nested values become JSON text."""

    def as_text(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _KEPT_TYPES):
            return column
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(column).alias(field.name)
        return column.cast("string").alias(field.name)

    return df.select(*[as_text(f) for f in df.schema.fields])
