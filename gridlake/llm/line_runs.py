"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line hashes, each with the number of documents that hold the line and the largest
of their ids, bucketed and sorted by hash. A batch of documents arrives as such a run. A merge
anti-join with the runs at hand leaves the hashes that are new: they become a run of level 0. The
others are kept as a tally beside them. When a level has ``fanout`` runs they are merged into one run
of the next level. No hash is in two runs, so runs are never searched twice for one, and since all
runs share their buckets the joins move nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import common
from gridlake.operators.windows import match_keys
from gridlake.session import scratch_path

#: Shortest key in code points, least number of documents, white space of a key's ends.
MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\x0b\x0c\r"

#: Batches that ``dedup_lines`` deals documents to, and runs of a level before they are merged.
BATCHES = 4
FANOUT = 2

KEYS = ["h", "i"]


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """Digest of the key of a line; None for a short one. ``bytes.lower`` touches A-Z alone."""
    key = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, h, i): the different long lines of each row, by the halves of their digest; ``th``
    is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, names = [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                keys = {line_key(x, min_chars) for x in (text or "").split("\n") if len(x) >= min_chars} - {None}
                row += [at] * len(keys)
                names += keys
            halves = pa.array([int.from_bytes(x[:8], "little", signed=True) for x in names], pa.int64())
            others = pa.array([int.from_bytes(x[8:], "little", signed=True) for x in names], pa.int64())
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("th").take(take), halves, others], ["doc_id", "th", "h", "i"]
            )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    return rows.mapInArrow(run, "doc_id long, th long, h long, i long")


def merged_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs as one. Their hashes differ, so the outer merge join only puts them in order."""
    b = b.withColumnsRenamed({"n": "_n", "top": "_top"}).hint("merge")
    return a.join(b, KEYS, "full_outer").select(*KEYS, F.coalesce("n", "_n").alias("n"), F.coalesce("top", "_top").alias("top"))


class LineRuns:
    """Runs by level, and tallies of hashes met again. Tables are written in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.tallies: list[str] = []
        self.compactions = 0
        self._paths: dict[str, str] = {}

    def sorted_run(self, df: DataFrame, by: str | None = None) -> str:
        """Write hashes as a table in the buckets that all runs share, sorted; ``by`` names a column
        to part it by. Tasks that hold one bucket each write one file each."""
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "lines")
        writer = df.write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS)
        writer = writer.partitionBy(by) if by else writer
        writer.option("path", path).format("parquet").saveAsTable(name)
        self._paths[name] = path
        return name

    def drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            common.dropped(self.spark, self._paths.pop(name))

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Take in a batch: (h, i, n, top), each hash once, from a table of ``sorted_run``."""
        runs = [r.select(*KEYS) for r in self.runs()]
        fresh = reduce(lambda rest, run: rest.join(run.hint("merge"), KEYS, "left_anti"), runs, batch)
        if runs:
            again = [batch.join(run.hint("merge"), KEYS, "left_semi") for run in runs]
            self.tallies += [self.sorted_run(part) for part in again]
        self._put(0, self.sorted_run(fresh))

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self.sorted_run(reduce(merged_runs, [self.spark.table(x) for x in old]))
            self.drop(*old)
            self.compactions += 1
            self._put(level + 1, merged)

    def counts(self) -> DataFrame:
        """(h, i, n, top) of every hash over all batches."""
        found = reduce(DataFrame.union, [r.select(*KEYS, "n", "top") for r in self.runs()])
        if not self.tallies:
            return found
        tallies = reduce(DataFrame.union, [self.spark.table(t).select(*KEYS, "n", "top") for t in self.tallies])
        more = tallies.groupBy(*KEYS).agg(F.sum("n").alias("_n"), F.max("top").alias("_top"))
        total = F.col("n") + F.coalesce("_n", F.lit(0))
        both = [
            r.select(*KEYS, "n", "top").join(more, KEYS, "left").select(*KEYS, total.alias("n"), F.greatest("top", "_top").alias("top"))
            for r in self.runs()
        ]
        return reduce(DataFrame.union, both)

    def close(self) -> None:
        self.drop(*list(self._paths))


def repeated_lines(pairs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> tuple[DataFrame, str]:
    """(h, i, top): hashes that ``min_docs`` rows hold, and the largest id among those, as a written
    table with its path. ``pairs`` are rows of ``line_hashes``."""
    store = LineRuns(pairs.sparkSession, fanout)
    dealt = pairs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "th"), F.lit(batches)).cast("int"))
    # A frequent line is one row for each task and batch before anything moves.
    heads = dealt.groupBy("batch", *KEYS).agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
    staged = store.sorted_run(heads.repartition(store.buckets, *KEYS), by="batch")
    for batch in range(batches):
        store.add(store.spark.table(staged).where(F.col("batch") == batch).select(*KEYS, "n", "top"))
    gone = common.written(store.counts().where(F.col("n") >= min_docs).select(*KEYS, "top"), "lines-gone")
    store.close()
    return gone


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT, keep: bool = False
) -> DataFrame:
    """Texts without the lines that stay in another document: doc_id, n_lines, n_dropped, kept_sha256
    and, with ``keep``, the text that is left.

    A line's key is the line without white space at its ends, A-Z in lower case. A key of ``min_chars``
    code points or more that ``min_docs`` rows hold loses its lines everywhere but in the rows with the
    largest doc_id that holds it. NULL ids are smaller than all others; where only such rows hold a key
    they keep it. Rows alike in id and text count one by one and have the same result.

    A NULL or empty text is one empty line, which stays. Texts may have any length; a task holds one
    batch of rows. Other columns are ignored."""
    pairs, pairs_path = common.written(line_hashes(docs, min_chars), "line-hashes")
    gone, gone_path = repeated_lines(pairs, min_docs, batches, fanout)
    hits = match_keys(pairs, gone, KEYS).where(~F.col("doc_id").eqNullSafe(F.col("top")))
    each = hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct(*KEYS)).alias("gone"))
    each, _ = common.written(each.select("doc_id", "th", "gone"), "line-drops")
    common.dropped(docs.sparkSession, pairs_path, gone_path)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    both = match_keys(rows, each, ["doc_id", "th"], "left").select("doc_id", "text", "gone")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out = []
            for doc_id, text, lost in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "gone"))):
                lines = (text or "").split("\n")
                kept = lines
                if lost:
                    names = {x["h"].to_bytes(8, "little", signed=True) + x["i"].to_bytes(8, "little", signed=True) for x in lost}
                    kept = [x for x in lines if len(x) < min_chars or line_key(x, min_chars) not in names]
                left = "\n".join(kept)
                out.append((doc_id, len(lines), len(lines) - len(kept), common.sha256(left.encode()), *([left] if keep else [])))
            columns = list(zip(*out)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string()), *([("text", pa.string())] if keep else [])])
    return both.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + (", text string" if keep else ""))
