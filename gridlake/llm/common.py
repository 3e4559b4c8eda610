"""Helpers shared by the corpus operators: tables, scratch tables, byte buffers, span removal."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import remove_path, scratch_path

#: Bytes of zeros between the texts of a buffer, so that rolling hashes at the start of a text
#: depend on that text alone. At least the longest rolling window.
PAD = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(name: str, columns: list[str]) -> str:
    """``name``, or that with underscores behind it, so that no column is called alike."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def few_rows(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs that start in here hand ``rows`` texts at once to Python and back, which bounds what a batch takes in
    an executor and its workers and changes no result; None: as the session says."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if rows is not None:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def at_most(spark: SparkSession, rows: int) -> None:
    """From now on jobs of the session hand ``rows`` rows or fewer at once to Python and back: unlike ``few_rows``
    also those of a frame that runs after its maker has returned. A smaller setting stays; no result changes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:  # 0 and less: no bound
        spark.conf.set(name, rows)


def written(df: DataFrame, label: str, rows: int | None = None) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, so lineage ends there and lost executors cost
    nothing. Returns the reread frame and its path, for ``dropped``. ``rows``: see ``few_rows``."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with few_rows(spark, rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        remove_path(spark, path)


def buffers(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of a batch side by side: (rows, bytes, starts, lengths), in slices of about ``limit``
    bytes (one row at least). NULL counts as empty. ``PAD`` zeros stand before each text and at
    the end."""
    for part, lengths in slices(batches, column, limit):
        texts = part.column(column).cast(pa.large_binary()).to_pylist()
        gap = bytes(PAD)
        joined = np.frombuffer(gap + gap.join(t or b"" for t in texts) + gap, np.uint8)
        starts = PAD + np.concatenate([[0], np.cumsum(lengths + PAD)[:-1]])
        yield part, joined, starts, lengths


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches in slices of about ``limit`` bytes of text (one row at least), and the length of each text. NULL
    counts as empty. For readers of the texts themselves, who need no bytes side by side."""
    for batch in batches:
        sizes = np.array(pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), np.int64)
        at = 0
        while at < len(sizes):
            upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, "right")))
            yield batch.slice(at, upto - at), sizes[at:upto]
            at = upto


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i : i + width]`` for each full window."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open intervals as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    """``raw`` less the (sorted, disjoint) runs."""
    kept, at = [], 0
    for a, b in runs:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]])


def sha256(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph given by rows (a, b) of longs.

    Returns (node, component), component being the smallest node reachable; nodes without an
    edge do not appear. Alternating large-star and small-star steps: each joins a node with its
    smallest neighbour only, so no step ever holds a whole neighbourhood, and the number of
    rounds is logarithmic. Every round is a written table."""
    spark = edges.sparkSession
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    links, path = written(links, "links")
    while True:
        both = links.union(links.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: neighbours above a node hang on the smallest of its neighbourhood.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its lower neighbours hang on the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        following, next_path = written(small, "links")
        changed = following.exceptAll(links).limit(1).count() or links.exceptAll(following).limit(1).count()
        dropped(spark, path)
        links, path = following, next_path
        if not changed:
            break
    tops = links.select(F.col("b").alias("node")).distinct()
    return links.toDF("node", "component").union(tops.select("node", F.col("node").alias("component")))
