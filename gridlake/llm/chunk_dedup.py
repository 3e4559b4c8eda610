"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of each text; a chunk ends where the hash is the smallest
within ``radius`` bytes on both sides. Cuts depend on the bytes around them only, so text
inserted anywhere moves no cut further than that. Chunks are named by their 128-bit digest; of
each digest the first occurrence stays (by doc_id, then position), later ones go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common
from gridlake.llm.filters import fixed_filter, in_filter

#: Bytes on each side of a cut over which its hash is the smallest; chunks are longer than this.
RADIUS = 28
#: A chunk without a natural cut (one byte repeated, say) is cut after so many bytes.
MAX_CHUNK = 4096
#: Runs of repeated chunks under so many bytes stay; at 1 every chunk that occurred before goes.
MIN_RUN = 1
#: Bytes of texts that a task hashes at once: each takes some forty bytes of a worker meanwhile. And rows that
#: go to Python and back at once.
SLICE, ROWS = 1 << 19, 1000

#: Gear table from a rule: one random-looking 32-bit value for each byte.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 7) for i in range(256)], np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j for j < 32, modulo 2**32, for all i at once: the
    window doubles in each step, since older bytes have been shifted out of the 32 bits."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def slices(batches: Iterator[pa.RecordBatch]):
    return common.buffers(batches, "text", SLICE)


def cuts(data: np.ndarray, radius: int) -> np.ndarray:
    """Positions that start a new chunk: just behind a local minimum of the gear hash, moved on
    to the next first byte of a character."""
    h = gear_hash(data)
    low = common.sliding_min(h, radius)
    own = h[radius : len(h) - radius]
    at = np.flatnonzero((own < low[: len(own)]) & (own <= low[radius + 1 :][: len(own)])) + radius + 1
    for _ in range(3):
        at = at + ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80)
    return at


def chunks(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, radius: int, longest: int):
    """(row, start within the text, length) of each chunk of each text of a buffer."""
    at = cuts(data, radius)
    row = np.searchsorted(starts, at, "right") - 1
    inside = (row >= 0) & (at > starts[row]) & (at < starts[row] + lengths[row])
    full = np.flatnonzero(lengths)
    begin = np.unique(np.concatenate([starts[full], at[inside]]))
    row = np.searchsorted(starts, begin, "right") - 1
    end = np.append(begin[1:], 0)
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    end[last] = starts[row[last]] + lengths[row[last]]
    if len(begin) and (end - begin).max() > longest:
        pieces = -((begin - end) // longest)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        row, stop = np.repeat(row, pieces), np.repeat(end, pieces)
        begin = np.repeat(begin, pieces) + nth * longest
        while (inner := (data[begin] & 0xC0) == 0x80).any():
            begin = begin - inner
        end = np.minimum(np.append(begin[1:], stop[-1:]), stop)
    return row, begin - starts[row], end - begin


def chunk_table(docs: DataFrame, radius: int = RADIUS, longest: int = MAX_CHUNK, known=None) -> DataFrame:
    """(doc_id, th, start, size, d1, d2): the chunks of all texts, d1 and d2 being the digest. ``known``: a broadcast
    filter of d1; chunks that are not in it are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, starts, lengths in slices(batches):
            row, start, size = chunks(data, starts, lengths, radius, longest)
            view, digest = memoryview(data), xxhash.xxh3_128_digest
            begin = starts[row] + start
            names = b"".join([digest(view[a:b]) for a, b in zip(begin.tolist(), (begin + size).tolist())])
            names = np.frombuffer(names, "<i8").reshape(-1, 2)
            if known is not None:
                on = np.flatnonzero(in_filter(known.value, names[:, 0]))
                row, start, size, names = row[on], start[on], size[on], names[on]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), part.column("th").take(pa.array(row)),
                 pa.array(start, pa.int64()), pa.array(size, pa.int32()),
                 pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy())],
                ["doc_id", "th", "start", "size", "d1", "d2"],
            )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    return rows.mapInArrow(run, "doc_id long, th long, start long, size int, d1 long, d2 long")


def dedup_chunks(
    docs: DataFrame, radius: int = RADIUS, longest: int = MAX_CHUNK, min_run: int = MIN_RUN
) -> DataFrame:
    """Texts without the chunks that occurred before.

    Returns one row per document: doc_id, n_bytes, n_chunks, n_repeated (chunks whose first
    occurrence is elsewhere), n_removed (bytes), n_spans, spans ("start:end" in bytes,
    comma-joined), kept_in (doc_ids that keep the removed chunks, ascending), text (what stays).

    NULL text counts as empty and gives an empty text. A document with a NULL id comes after all
    others. Rows alike in id and text are the same document: each gives the same result and none
    removes the other's text. Other columns are ignored.

    Digests are counted with map-side combining; only those that recur are joined back to the
    chunks that a filter of fixed size lets pass, in a join that adaptive execution splits at frequent
    digests. The digests that recur and the chunks that go are written tables."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    found = chunk_table(rows, radius, longest)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "start")
    first = found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("final"))
    again = first.where("first.doc_id <> final.doc_id or first.last <> final.last or first.th <> final.th or first.start <> final.start")
    again = again.select("d1", "d2", F.col("first.doc_id").alias("f_doc"), F.col("first.th").alias("f_th"), F.col("first.start").alias("f_start"))
    again, again_path = common.written(again, "again", ROWS)
    known = spark.sparkContext.broadcast(fixed_filter(again.select(F.col("d1").alias("k")), ROWS))
    later = chunk_table(rows, radius, longest, known).join(again, ["d1", "d2"]).where("not (doc_id <=> f_doc and th = f_th and start = f_start)")
    each = later.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "size", "f_doc")).alias("gone"))
    each, _ = common.written(each, "gone", ROWS)
    common.dropped(spark, again_path)
    docs_th = rows.withColumn("th", F.xxhash64("text"))
    kept = docs_th.alias("d").join(
        each.alias("e"), F.col("d.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("d.th") == F.col("e.th")), "left"
    )
    counts = kept.select("d.doc_id", "d.text", "e.gone")
    schema = (
        "doc_id long, n_bytes long, n_chunks long, n_repeated long, n_removed long, n_spans long, spans string, "
        "kept_in array<long>, text string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, starts, lengths in slices(batches):
            row, _, _ = chunks(data, starts, lengths, radius, longest)
            n_chunks = np.bincount(row, minlength=len(starts))
            out = []
            for i, (doc_id, gone) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("gone").to_pylist())):
                raw = data[starts[i] : starts[i] + lengths[i]].tobytes()
                gone = gone or []
                runs = [
                    x for x in common.merged([(g["start"], g["start"] + g["size"]) for g in gone]) if x[1] - x[0] >= min_run
                ]
                ends = [b for _, b in runs]
                within = np.searchsorted(ends, [g["start"] for g in gone], "right") if runs else []
                held = {g["f_doc"] for g, k in zip(gone, within) if k < len(runs) and runs[k][0] <= g["start"]}
                out.append({
                    "doc_id": doc_id, "n_bytes": len(raw), "n_chunks": int(n_chunks[i]), "n_repeated": len(gone),
                    "n_removed": sum(b - a for a, b in runs), "n_spans": len(runs),
                    "spans": ",".join(f"{a}:{b}" for a, b in runs),
                    "kept_in": sorted(x for x in held if x is not None),
                    "text": common.without(raw, runs).decode("utf-8", "replace"),
                })
            yield pa.RecordBatch.from_pylist(out, OUT)

    return counts.mapInArrow(run, schema)


OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chunks", pa.int64()), ("n_repeated", pa.int64()),
    ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.string()),
    ("kept_in", pa.list_(pa.int64())), ("text", pa.string()),
])
