"""Bytes covered by a string of ``length`` bytes that starts more than once in the corpus.

Which suffixes can share so long a prefix is narrowed down first, without loss. Each start s has
an anchor: the position with the smallest hash among the ``width`` short strings from s on. Two
equal strings of ``length`` bytes have their anchors at equal distance, and agree in the *core*,
the bytes behind the anchor that all starts of the anchor share. So

1. cores are counted; anchors whose core occurs once are done;
2. anchors are counted by core and by *context*, all bytes that their starts cover. A context
   that recurs as a whole is covered as a whole;
3. one suffix array in compressed form, a Burrows-Wheeler transform, is made of the remaining
   contexts shard by shard, over an alphabet of blocks of bytes. Shards are merged by refining
   their interleaving: in round h the rows stand in the order of their first h blocks, and a
   boundary that first shows in round h tells a common prefix of h - 1 blocks. Where none has
   shown after ``length`` bytes lies a repeated interval. No suffix is sorted again;
4. cores with so many different contexts that they would fill a task are not gathered: each of
   their strings is named by a 128-bit digest and counted.
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

LENGTH = 400
WIDTH = 160
GRAM = 16
BLOCK = 100
#: Short cores, and the starts that share one: any string of SHORT + SHORT_WIDTH - 1 bytes that recurs
#: has one of its own.
SHORT, SHORT_WIDTH = 160, 60
#: Different contexts of one core that a task gathers; cores with more are counted by digest.
GATHERED = 200
#: Rows of a shard's transform, and shards merged at once: what a task holds.
SHARD_ROWS, SHARDS = 150_000, 4
#: Bytes of texts that a task hashes at once: each takes some fifty bytes of a worker meanwhile. And rows that
#: go to Python and back at once.
SLICE, ROWS = 1 << 19, 1000

MIX = np.array([xxhash.xxh64_intdigest(bytes([i]), 11) for i in range(256)], np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_2 = np.uint64(0xC2B2AE3D27D4EB4F)


# -------------------------------------------------------------------------------------- anchors


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    return common.written(df, label, ROWS)


def slices(batches: Iterator[pa.RecordBatch]):
    return common.buffers(batches, "text", SLICE)


def gram_hash(data: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of each string of ``size`` (a power of two) bytes."""
    h, have = MIX[data], 1
    while have < size:
        longer = h[:-have] * np.uint64(pow(int(BASE), have, 1 << 64))
        longer += h[have:]
        h, have = longer, 2 * have
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int, width: int):
    """(row, first start, number of starts, anchor), positions in the buffer, in order. The
    starts of an anchor are consecutive."""
    place = np.uint64((1 << 31) - 1)
    h = gram_hash(data, GRAM)
    h &= ~place
    h |= np.arange(len(h), dtype=np.uint64)
    low = common.sliding_min(h, width)
    many = np.maximum(lengths - length + 1, 0)
    # An anchor's starts begin where the minimum changes, or with the text.
    change = np.flatnonzero(low[1:] != low[:-1]) + 1
    row = np.maximum(np.searchsorted(starts, change, "right") - 1, 0)
    change = change[(change > starts[row]) & (change < starts[row] + many[row])] if len(starts) else change[:0]
    first = np.sort(np.concatenate([starts[many > 0], change]))
    row = np.searchsorted(starts, first, "right") - 1
    ends = np.minimum(np.append(first[1:], len(data))[: len(first)], starts[row] + many[row])
    return row, first, ends - first, (low[first] & place).astype(np.int64)


def _core(length: int, width: int) -> int:
    return length - width + 1


def row_key(doc_th: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (doc_th.astype(np.uint64) * BASE_2 + place.astype(np.uint64)) * BASE


def _cores(view, at: np.ndarray, size: int) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(view[a : a + size]) for a in at.tolist()], np.uint64).view(np.int64)


def _contexts(view, first: np.ndarray, many: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """128-bit digests, seeded with where the anchor stands and how many starts there are."""
    digest = xxhash.xxh3_128_digest
    seeds = ((at - first) << 20 | many).tolist()
    ends = (first + many + length - 1).tolist()
    raw = b"".join([digest(view[a:b], seed) for a, b, seed in zip(first.tolist(), ends, seeds)])
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


# --------------------------------------------------------------------------------- transforms


class Transform:
    """Burrows-Wheeler transform of a shard, over blocks.

    ``order`` lists the suffixes (numbers given by the caller) in the order of their first blocks,
    suffixes without a block first; ``before`` is the block that precedes each, -1 for none."""

    def __init__(self, order: np.ndarray, before: np.ndarray, ends: int):
        self.order, self.before, self.ends = order, before, ends


def shard_transform(previous: np.ndarray, before: np.ndarray, ending: np.ndarray, base: int, depth: int) -> Transform:
    """``previous``: the suffix one block earlier or -1; ``before``: that block or -1."""
    ends = np.flatnonzero(ending)
    order = np.arange(len(previous))
    for _ in range(depth):
        kept = order[before[order] >= 0]
        kept = kept[np.argsort(before[kept], kind="stable")]
        order = np.concatenate([ends, previous[kept]])
    return Transform(order + base, before[order], len(ends))


def interleave(a: Transform, b: Transform, depth: int) -> tuple[Transform, np.ndarray]:
    """Merge two transforms; also the common prefix, in blocks (``depth`` at most), of each row
    with the row above.

    Only the transforms are read: rows of either shard keep their order, so the interleaving is
    one bit a row, and sorting the bits by preceding block, stably, sorts one block deeper."""
    n = len(a.order) + len(b.order)
    before = np.concatenate([a.before, b.before])
    z = np.append(np.zeros(len(a.order), bool), np.ones(len(b.order), bool))
    top = np.append(np.zeros(a.ends, bool), np.ones(b.ends, bool))
    group = np.zeros(n, np.int64)
    prefix = np.full(n, depth, np.int8)
    for h in range(1, depth + 1):
        at = np.where(z, len(a.order) + np.cumsum(z) - 1, np.cumsum(~z) - 1)
        c = before[at]
        kept = np.flatnonzero(c >= 0)
        kept = kept[np.argsort(c[kept], kind="stable")]
        c, group, z = c[kept], group[kept], np.append(top, z[kept])
        new = np.append(True, (c[1:] != c[:-1]) | (group[1:] != group[:-1])) if len(c) else np.zeros(0, bool)
        group = np.append(np.zeros(len(top), np.int64), np.cumsum(new))
        shown = len(top) + np.flatnonzero(new)
        prefix[shown] = np.minimum(prefix[shown], h - 1)
    at = np.where(z, len(a.order) + np.cumsum(z) - 1, np.cumsum(~z) - 1)
    prefix[:1] = 0
    return Transform(np.concatenate([a.order, b.order])[at], before[at], len(top)), prefix


def repeated_starts(contexts: list[bytes], many: np.ndarray, weight: np.ndarray, length: int, block: int) -> np.ndarray:
    """Flags for all starts of all contexts, one context after the other: does the string of
    ``length`` bytes there start elsewhere too? A context of weight over 1 stands for more."""
    depth = length // block
    data = np.frombuffer(b"".join(contexts), np.uint8)
    base = np.cumsum([0] + [len(c) for c in contexts])[:-1]
    # Suffixes: for each start its position, one block on, and so on to the end of the string.
    hop = np.minimum(many, block)  # starts one block apart share their further suffixes
    rows = many + depth * hop
    first = np.cumsum(rows) - rows
    owner = np.repeat(np.arange(len(contexts)), rows)
    nth = np.arange(rows.sum()) - first[owner]
    head = nth < many[owner]
    k = nth - many[owner]
    # Behind the starts: per block further on, the positions not reached yet.
    level = np.where(head, 0, k // np.maximum(hop[owner], 1) + 1)
    offset = np.where(head, nth, many[owner] - hop[owner] + k % np.maximum(hop[owner], 1) + level * block)
    position = base[owner] + offset
    key = owner.astype(np.int64) << 32 | offset
    sort = np.argsort(key, kind="stable")
    ranked = key[sort]

    def find(want: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(ranked, want), len(ranked) - 1)
        return np.where(ranked[at] == want, sort[at], -1)

    ending = offset > (many[owner] - 1 + length - block)
    prefix_sum, power = _prefix(data, BASE | np.uint64(1))
    held = np.flatnonzero(~ending)
    names = _span_hash(prefix_sum, power, position[held], block)
    _, ids = np.unique(names, return_inverse=True)
    symbol = np.full(len(owner), -1, np.int64)
    symbol[held] = ids
    previous = np.where(offset >= block, find(key - block), -1)
    before = np.where(previous >= 0, symbol[previous], -1)
    # Shards of whole contexts.
    upto = np.flatnonzero(np.diff((first + rows) // SHARD_ROWS, append=-1))
    transforms, lo = [], 0
    for context in upto:
        hi = int(first[context] + rows[context])
        own = previous[lo:hi]
        transforms.append(
            shard_transform(np.where(own >= 0, own - lo, -1), before[lo:hi], ending[lo:hi], lo, depth)
        )
        lo = hi
    empty = Transform(np.zeros(0, np.int64), np.zeros(0, np.int64), 0)
    while len(transforms) > 2:
        pairs = [transforms[i : i + 2] for i in range(0, len(transforms), 2)]
        transforms = [interleave(*p, depth)[0] if len(p) == 2 else p[0] for p in pairs]
    whole, prefix = interleave(*(transforms + [empty])[:2], depth)
    # Repeated intervals: runs of rows in which no boundary showed. A second hash confirms them.
    sums_2, power_2 = _prefix(data, BASE_2 | np.uint64(1))
    rows_in = np.flatnonzero(head[whole.order])
    run = np.cumsum(prefix < depth)[rows_in]
    suffix = whole.order[rows_in]
    second = _span_hash(sums_2, power_2, position[suffix], length)
    differs = np.append(True, (run[1:] != run[:-1]) | (second[1:] != second[:-1])) if len(run) else np.zeros(0, bool)
    run = np.cumsum(differs) - 1
    total = np.bincount(run, weight[owner[suffix]]) if len(run) else np.zeros(0)
    again = np.zeros(len(owner), bool)
    again[suffix] = total[run] >= 2
    return again[head]


def _prefix(data: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    power = np.full(len(data) + 1, base)
    power[0] = 1
    power = np.multiply.accumulate(power)
    return np.append(np.uint64(0), np.cumsum(MIX[data] * power[:-1], dtype=np.uint64)), power


def _span_hash(sums: np.ndarray, power: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` bytes, the same wherever they stand."""
    return (sums[at + size] - sums[at]) * power[len(power) - 1 - at]


# ------------------------------------------------------------------------------------ operator


def shared_passages(rows: DataFrame) -> tuple[DataFrame, str]:
    """(doc_id, th, shared) of rows (doc_id, text, th): how many anchored strings of SHORT bytes of a row
    stand anywhere else too, for rows that have one; and the path of the table. Passages that are too
    short for ``length`` show here."""
    spark = rows.sparkSession
    reach = SHORT + SHORT_WIDTH - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, starts, lengths in slices(batches):
            at = anchors(data, starts, lengths, reach, SHORT_WIDTH)[3]
            yield pa.RecordBatch.from_arrays([pa.array(_cores(memoryview(data), at, SHORT))], ["k"])

    again = rows.select("text").mapInArrow(count, "k long").groupBy("k").count().where("count > 1").select("k")
    again, again_path = _written(again, "passages")
    known = spark.sparkContext.broadcast(fixed_filter(again, ROWS))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, starts, lengths in slices(batches):
            row, _, _, at = anchors(data, starts, lengths, reach, SHORT_WIDTH)
            k = _cores(memoryview(data), at, SHORT)
            on = np.flatnonzero(in_filter(known.value, k))
            take = pa.array(row[on])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(take), part.column("th").take(take), pa.array(k[on])], ["doc_id", "th", "k"])

    found = rows.mapInArrow(find, "doc_id long, th long, k long").join(again, "k", "left_semi")
    out, path = _written(found.groupBy("doc_id", "th").agg(F.count("*").alias("shared")), "shared")
    common.dropped(spark, again_path)
    return out, path


def remove_repeats(docs: DataFrame, length: int = LENGTH, width: int = WIDTH, block: int = BLOCK, keep: bool = False) -> DataFrame:
    """Texts less every byte covered by a ``length``-byte string that also starts elsewhere.

    Returns one row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the remaining bytes, lowercase hex), n_shared (see ``shared_passages``); with ``keep``
    also kept (binary).

    Texts are UTF-8 bytes, NULL is empty; no match crosses documents; a repeated row is another
    document. NULL ids are ids like others here. Other columns are ignored. ``length`` is a
    multiple of ``block`` and at least ``width`` + GRAM."""
    if length % block or length < width + GRAM:
        raise ValueError("length must be a multiple of block, and at least width + GRAM")
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("th"))
    core = _core(length, width)

    def count_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, starts, lengths in slices(batches):
            at = anchors(data, starts, lengths, length, width)[3]
            yield pa.RecordBatch.from_arrays([pa.array(_cores(memoryview(data), at, core))], ["k"])

    cores = rows.select("text").mapInArrow(count_cores, "k long").groupBy("k").count().where("count > 1").select("k")
    shared = spark.sparkContext.broadcast(fixed_filter(cores, ROWS))

    def shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, starts, lengths in slices(batches):
            row, first, many, at = anchors(data, starts, lengths, length, width)
            view = memoryview(data)
            r = _cores(view, at, core)
            on = np.flatnonzero(in_filter(shared.value, r))
            row, first, many, at = row[on], first[on], many[on], at[on]
            f = _contexts(view, first, many, at, length)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), part.column("th").take(pa.array(row)),
                 pa.array(first - starts[row]), pa.array(many, pa.int32()), pa.array(r[on]),
                 pa.array(f[:, 0].copy()), pa.array(f[:, 1].copy())],
                ["doc_id", "th", "first", "many", "r", "f1", "f2"],
            )

    found, found_path = _written(
        rows.mapInArrow(shared_anchors, "doc_id long, th long, first long, many int, r long, f1 long, f2 long"), "anchors"
    )
    # All columns of a representative come from one row: Spark's first() takes them together.
    by_context = found.groupBy("r", "f1", "f2").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("doc_id", "th", "first", "many")]
    )
    by_context, context_path = _written(by_context, "contexts")
    by_core = by_context.groupBy("r").agg(F.count("*").alias("m"), F.sum((F.col("n") == 1).cast("int")).alias("single"))
    open_cores = by_core.where("m > 1 and single > 0").select("r", "m")
    wanted = by_context.join(open_cores, "r").select("r", "th", "first", "n", "m")
    wanted, wanted_path = _written(wanted, "wanted")

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = row_key(b.column("th").to_numpy(), b.column("first").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64))], ["k"])

    chosen = spark.sparkContext.broadcast(fixed_filter(wanted.select("th", "first").mapInArrow(key, "k long"), ROWS))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, starts, lengths in slices(batches):
            row, first, many, at = anchors(data, starts, lengths, length, width)
            th = part.column("th").to_numpy()
            on = np.flatnonzero(in_filter(chosen.value, row_key(th[row], first - starts[row])))
            row, first, many = row[on], first[on], many[on]
            raw = data.tobytes()
            text = [raw[a : a + n + length - 1] for a, n in zip(first.tolist(), many.tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), pa.array(th[row]), pa.array(first - starts[row]),
                 pa.array(many, pa.int32()), pa.array(text, pa.binary())],
                ["doc_id", "th", "first", "many", "context"],
            )

    contexts = rows.mapInArrow(cut_out, "doc_id long, th long, first long, many int, context binary")
    contexts = contexts.dropDuplicates(["th", "first"]).join(wanted, ["th", "first"])
    contexts, contexts_path = _written(contexts, "cut")

    def merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows_held = [], 0

        def flush():
            many = np.array([h["many"] for h in held], np.int64)
            again = repeated_starts([h["context"] for h in held], many, np.array([h["n"] for h in held]), length, block)
            out = []
            for h, flags in zip(held, np.split(again, np.cumsum(many)[:-1])):
                step = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
                for a, b in step.reshape(-1, 2).tolist():
                    if h["n"] == 1:
                        out.append((h["doc_id"], h["th"], h["first"] + a, h["first"] + b - 1 + length))
            columns = list(zip(*out)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "th", "a", "b"]
            )

        for batch in batches:
            for h in batch.to_pylist():
                # Cores stay together: rows come sorted by core, and a core is bounded.
                if rows_held >= SHARD_ROWS * SHARDS and h["r"] != held[-1]["r"]:
                    yield flush()
                    held, rows_held = [], 0
                held.append(h)
                rows_held += h["many"] * (length // block + 1)
        if held:
            yield flush()

    spans_schema = "doc_id long, th long, a long, b long"
    gathered = contexts.where(F.col("m") <= GATHERED).repartition("r").sortWithinPartitions("r")
    merged = gathered.select("r", "doc_id", "th", "first", "many", "n", "context").mapInArrow(merge_shards, spans_schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                many = b.column("many").to_numpy()
                row = np.repeat(np.arange(b.num_rows), many)
                nth = np.concatenate([np.arange(m) for m in many])
                raw = b"".join([
                    xxhash.xxh3_128_digest(c[i : i + length])
                    for c, m in zip(b.column("context").to_pylist(), many.tolist()) for i in range(m)
                ])
                d = np.frombuffer(raw, "<i8").reshape(-1, 2)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(take), b.column("th").take(take), b.column("n").take(take),
                     pa.array(b.column("first").to_numpy()[row] + nth), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())],
                    ["doc_id", "th", "n", "s", "d1", "d2"],
                )

    crowded = contexts.where(F.col("m") > GATHERED).select("doc_id", "th", "first", "many", "n", "context")
    strings = crowded.mapInArrow(digests, "doc_id long, th long, n long, s long, d1 long, d2 long")
    more = strings.groupBy("d1", "d2").agg(F.sum("n").alias("total")).where("total > 1").select("d1", "d2")
    counted = strings.where("n = 1").join(more, ["d1", "d2"]).select("doc_id", "th", F.col("s").alias("a"), (F.col("s") + length).alias("b"))
    covered = found.join(by_context.where("n > 1").select("r", "f1", "f2"), ["r", "f1", "f2"]).select(
        "doc_id", "th", F.col("first").alias("a"), (F.col("first") + F.col("many") - 1 + length).alias("b")
    )
    shared, _ = shared_passages(rows)
    every = covered.union(merged).union(counted).withColumn("shared", F.lit(0).cast("long"))
    every = every.unionByName(shared.where("shared > 0"), allowMissingColumns=True)
    spans = every.groupBy("doc_id", "th").agg(
        F.collect_set(F.when(F.col("a").isNotNull(), F.struct("a", "b"))).alias("spans"), F.max("shared").alias("shared")
    )
    joined = rows.alias("d").join(
        spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.th") == F.col("s.th")), "left"
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, starts, lengths in slices(batches):
            out = []
            for doc_id, gone, passages, a, n in zip(
                part.column("doc_id").to_pylist(), part.column("spans").to_pylist(), part.column("shared").to_pylist(), starts.tolist(), lengths.tolist()
            ):
                runs = common.merged([(x["a"], x["b"]) for x in gone or []])
                kept = common.without(data[a : a + n].tobytes(), runs)
                out.append((doc_id, n, n - len(kept), len(runs), common.sha256(kept), passages or 0, kept))
            columns = list(zip(*out))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared", "kept"][: 6 + keep]
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[: len(names)], kinds)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long" + ", kept binary" * keep
    return joined.select("d.doc_id", "d.text", "s.spans", "s.shared").mapInArrow(remove, schema)
