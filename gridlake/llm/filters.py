"""Bit filters of fixed size, for tasks that look for rare values among many."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import few_rows

#: log2 of the bits of a filter sent to all tasks. The size never follows the data: a fuller filter
#: lets more values pass that are not in it, which costs time and changes no result.
FILTER_BITS = 25

MIX_1, MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(v: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    v = (v ^ (v >> np.uint64(31))) * MIX_1
    v = (v ^ (v >> np.uint64(29))) * MIX_2
    return v ^ (v >> np.uint64(32))


def _bit(values: np.ndarray) -> np.ndarray:
    return mix(values.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)


def fixed_filter(keys: DataFrame, rows: int | None = None) -> np.ndarray:
    """Filter of the longs in column ``k``. Tasks send the words they set; at most
    2**FILTER_BITS bits reach the driver. ``rows``: see ``common.few_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        for batch in batches:
            bit = _bit(batch.column(0).to_numpy())
            np.bitwise_or.at(own, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        full = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(own[full].view(np.int64))], ["w", "v"])

    with few_rows(keys.sparkSession, rows):
        words = keys.select("k").mapInArrow(run, "w int, v long").groupBy("w").agg(F.bit_or("v").alias("v")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64).view(np.uint64)
    return out


def in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """True for every value that is in the filter, and for a few that are not."""
    bit = _bit(values)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
