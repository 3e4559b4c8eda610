"""Token ids in Huffman-coded files.

Ids are counted over the whole corpus; a canonical code with at most ``limit`` bits a symbol is
built from the counts (package-merge). Documents are written in ascending order of their ids, in
blocks of whole documents. A block is a byte string that can be read by itself:

    magic "HIB1" | documents u32 | ids u64 | checkpoints u32 | words u32
    doc_id i64 x documents | 1 where doc_id is NULL, u8 x documents | ids u64 x documents
    bit offset u64 x checkpoints (one for each ``STRIDE`` ids) | code words, big-endian u32

(all but the code words little-endian). Blocks are the rows of a Parquet table, so that Spark
commits them whole; beside it lies a table of code lengths, which a canonical code follows from.
A decoder looks up ``limit`` bits at a time in one table, and follows all checkpoints of many
blocks in step.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import common
from gridlake.llm.units import UnitCache, kept

LIMIT = 16  # bits; more where more symbols than 2**LIMIT are in use
STRIDE = 128  # ids between checkpoints
BLOCK_IDS = 1 << 17  # a block is closed once it has so many ids
END_ID = 0
HEAD = struct.Struct("<4sIQII")


# ----------------------------------------------------------------------------------------- code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits; 0 for symbols that do not occur.

    Package-merge: level by level the packages of the level before are merged with the symbols;
    walking back, the cheapest items of a level tell how many symbols gain a bit there."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        place = np.argsort(both, kind="stable")
        levels.append(np.cumsum(place < len(weights)))
        both = both[place]
        both = both[: len(both) // 2 * 2]
        packages = both[::2] + both[1::2]
    take = 2 * len(weights) - 2
    for symbols in reversed(levels):
        here = int(symbols[take - 1]) if take else 0
        lengths[order[:here]] += 1
        take = 2 * (take - here)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code of each symbol: in order of length, then of symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    steps = np.uint64(1) << (np.uint64(64) - lengths[used].astype(np.uint64))  # of a 64-bit fraction
    first = np.cumsum(steps, dtype=np.uint64) - steps
    codes[used] = first >> (np.uint64(64) - lengths[used].astype(np.uint64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and length by the next bits of a stream, and how many bits to look at."""
    bits = int(lengths.max(initial=1))
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    spans = 1 << (bits - lengths[used].astype(np.int64))
    symbol, length = np.zeros(1 << bits, np.uint32), np.ones(1 << bits, np.uint8)
    symbol[: spans.sum()] = np.repeat(used, spans)
    length[: spans.sum()] = np.repeat(lengths[used], spans)
    return symbol, length, bits


# --------------------------------------------------------------------------------------- blocks


def pack_block(doc_ids: list[int | None], documents: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray) -> bytes:
    ids = np.concatenate(documents)
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    begin = ends - bits
    word, shift = begin >> 5, begin & 31
    both = codes[ids] << (64 - bits - shift).astype(np.uint64)
    n_words = int((ends[-1] + 31) >> 5) + 1
    # Bits of different ids never overlap, so sums are unions; each sum is under 2**32 and exact.
    words = np.bincount(word, (both >> np.uint64(32)).astype(np.float64), n_words)
    words += np.bincount(word + 1, (both & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words + 1)[:n_words]
    checks = begin[::STRIDE].astype("<u8")
    return b"".join([
        HEAD.pack(b"HIB1", len(doc_ids), len(ids), len(checks), n_words),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], "u1").tobytes(),
        np.array([len(x) for x in documents], "<u8").tobytes(),
        checks.tobytes(), words.astype(">u4").tobytes(),
    ])


def unpack_blocks(blocks: list[bytes], decoder) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc_ids, ids in each document, all ids) of each block; all blocks are decoded in step."""
    symbol, length, bits = decoder
    heads, words, lanes, counts, base = [], [], [], [], 0
    for raw in blocks:
        magic, n_docs, n_ids, n_checks, n_words = HEAD.unpack_from(raw)
        if magic != b"HIB1":
            raise ValueError("not a block of coded ids")
        at = HEAD.size
        doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
        absent = np.frombuffer(raw, "u1", n_docs, at := at + 8 * n_docs)
        sizes = np.frombuffer(raw, "<u8", n_docs, at := at + n_docs).astype(np.int64)
        checks = np.frombuffer(raw, "<u8", n_checks, at := at + 8 * n_docs).astype(np.int64)
        words.append(np.frombuffer(raw, ">u4", n_words, at + 8 * n_checks).astype(np.uint64))
        lanes.append(checks + 32 * base)
        left = np.full(n_checks, STRIDE)
        left[-1] = n_ids - STRIDE * (n_checks - 1)
        counts.append(left)
        base += n_words
        heads.append(([None if no else int(x) for x, no in zip(doc_ids, absent)], sizes, n_checks, n_ids))
    stream = np.concatenate([*words, np.zeros(1, np.uint64)])
    stream = (stream[:-1] << np.uint64(32)) | stream[1:]
    at, left = np.concatenate(lanes), np.concatenate(counts)
    out = np.zeros((STRIDE, len(at)), np.uint32)
    # Lanes with fewer ids than a stride (the last of each block) read on harmlessly.
    top = 32 * len(stream) - 1
    for step in range(int(left.max())):
        look = stream[at >> 5] >> ((64 - bits) - (at & 31)).astype(np.uint64)
        look = (look & np.uint64((1 << bits) - 1)).astype(np.int64)
        out[step] = symbol[look]
        at = np.minimum(at + length[look], top)
    out = out.T.reshape(-1)
    lane = 0
    for doc_ids, sizes, n_checks, n_ids in heads:
        yield doc_ids, sizes, out[lane * STRIDE : lane * STRIDE + n_ids]
        lane += n_checks


# ------------------------------------------------------------------------------------ tokenizer


class Encoder:
    """Byte-level BPE ids of whole texts by the tokenizers library.

    The library splits texts before spaces that a word follows, so a word with the space before
    it has the same ids everywhere and is looked up. Where white space meets white space across
    a unit's edge, or a special token's string occurs, the library gets the whole text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # The table below keeps words; the library meets each once, so that its own memory of words is no help.
        if hasattr(self.library.model, "_resize_cache"):
            self.library.model._resize_cache(0)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size()
        self.spaced = np.array([(self.library.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.cache = UnitCache(self._encode_units, limit=600_000)

    def whole(self, text: str) -> np.ndarray:
        # The batch call without offsets: the same ids in less time.
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _encode_units(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """A unit is what follows a space; the first of a text has a space behind it instead.
        Marks: 1 where white space opens a unit, 2 where it closes one."""
        odd = {unit for unit in units if not unit or unit.strip() != unit}
        plain, odd, marks = [unit for unit in units if unit not in odd], list(odd), []
        for unit in odd:
            end = unit[:-1] if unit[-1:] == " " else unit or " "
            marks.append((not unit or unit[0].isspace()) + 2 * end[-1:].isspace())
        ids, sizes = [], []
        for at in range(0, len(plain), 20_000):
            own = self.whole(" " + " ".join(plain[at : at + 20_000]))
            ids.append(own)
            sizes.append(np.diff(np.append(np.flatnonzero(self.spaced[own]), len(own))))
        for unit in odd:
            own = self.whole(unit[:-1] if unit[-1:] == " " else " " + unit)
            ids.append(own)
            sizes.append(np.array([len(own)]))
        marks = np.array([0] * len(plain) + marks)
        return plain + odd, np.concatenate(ids), np.concatenate(sizes), marks

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        rows, first = self._units(texts)
        marks = self.cache.marks[rows]
        meet = np.append(False, (marks[:-1] & 2 > 0) & (marks[1:] & 1 > 0))
        ids, each = self.cache.flat(rows)
        meet[first] = False
        odd = np.add.reduceat(meet, first, dtype=np.int64).tolist()
        ends = np.cumsum(np.add.reduceat(each, first)).tolist()
        return [
            self.whole(t) if o or any(s in t for s in self.special) else ids[a:b]
            for t, o, a, b in zip(texts, odd, [0, *ends], ends)
        ]


    def _units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row of each unit of the texts, and which units are the first of a text. Arrow tells the
        different units apart, so that each becomes a string and is looked up once."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        first, parts = split.offsets.to_numpy()[:-1].astype(np.int64), split.values
        later = np.ones(len(parts), bool)
        later[first] = False
        units = parts.filter(pa.array(later)).dictionary_encode()
        at = units.indices.to_numpy()
        opening = [text.partition(" ")[0] + " " for text in texts]
        times = np.append(np.bincount(at, minlength=len(units.dictionary)), np.ones(len(opening), np.int64))
        different = units.dictionary.to_numpy(zero_copy_only=False).tolist()  # far faster than to_pylist
        known = self.cache.rows(different + opening, times)
        rows = np.empty(len(parts), np.int64)
        rows[later], rows[first] = known[: len(units.dictionary)][at], known[len(units.dictionary) :]
        return rows, first


# ---------------------------------------------------------------------------------------- tables


def encode_table(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, th, ids, id, n): ids of each text and the end id, little-endian, in two bytes each where
    the vocabulary allows, else in four. Behind them, in rows of their own, how often each id came in a task;
    ``id`` is NULL in the rows of texts."""
    kind = id_type(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("ids", tokenizer), lambda: Encoder(tokenizer))
        names, total = ["doc_id", "th", "ids", "id", "n"], np.zeros(end_id + 1, np.int64)
        for part, _ in common.slices(batches, "text"):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids = [np.append(x, end_id).astype(kind).tobytes() for x in encoder.texts(texts)]
            got = np.bincount(np.frombuffer(b"".join(ids), kind))
            total = np.pad(total, (0, max(0, len(got) - len(total))))
            total[: len(got)] += got
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array(ids, pa.binary()), none, none], names)
        used = np.flatnonzero(total)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(used), pa.binary()), pa.array(used, pa.int64()), pa.array(total[used])], names)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    return rows.mapInArrow(run, "doc_id long, th long, ids binary, id long, n long")


def id_type(tokenizer: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def id_counts(encoded: DataFrame) -> np.ndarray:
    """Count of each id over all documents. What reaches the driver is bounded by the vocabulary."""
    found = encoded.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r.id] = r.n
    return counts


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, limit: int = LIMIT) -> None:
    """Encode whole texts and write ``path``/blocks and ``path``/code.

    NULL text counts as empty, so it holds the end id alone. Documents lie in ascending order of
    doc_id, NULL first, ties by text; an empty table gives empty tables. Other columns are
    ignored. The order comes from a range shuffle on (doc_id, hash of the text)."""
    spark = docs.sparkSession
    kind = id_type(tokenizer)
    encoded, scratch = common.written(encode_table(docs, tokenizer, end_id), "ids")
    lengths = code_lengths(id_counts(encoded), limit)
    codes = canonical(lengths)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in used], "id long, bits int"
    ).coalesce(1).write.parquet(f"{path}/code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, held, total = None, 0, [], 0

        def row():
            raw = pack_block([d for d, _ in held], [x for _, x in held], codes, lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([total], pa.int64()),
                 pa.array([raw], pa.binary())],
                ["part", "before", "n_ids", "data"],
            )

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                held.append((doc_id, np.frombuffer(ids, kind)))
                total += len(held[-1][1])
                if total >= BLOCK_IDS:
                    yield row()
                    before, held, total = before + total, [], 0
        if held:
            yield row()

    ordered = encoded.where("id is null").select("doc_id", "th", "ids").repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th")
    blocks = ordered.select("doc_id", "ids", F.spark_partition_id().alias("part"))
    blocks.mapInArrow(run, "part int, before long, n_ids long, data binary").write.parquet(f"{path}/blocks")
    common.dropped(spark, scratch)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the files, ids as little-endian u32.

    ``start`` counts the ids of all documents before it: those of the range partitions before (as
    many sums as partitions reach the driver) and those that the block counts within its own."""
    blocks = spark.read.schema("part int, before long, n_ids long, data binary").parquet(f"{path}/blocks")
    code = spark.read.schema("id long, bits int").parquet(f"{path}/code").collect()  # within the vocabulary
    lengths = np.zeros(max((r.id for r in code), default=0) + 1, np.uint8)
    for r in code:
        lengths[r.id] = r.bits
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    first = dict(zip([r.part for r in sizes], np.cumsum([0] + [r.n for r in sizes]).tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decode_table(lengths)
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                few = batch.slice(at, 16)
                starts = [first[p] + b for p, b in zip(few.column("part").to_pylist(), few.column("before").to_pylist())]
                for start, (doc_ids, n, ids) in zip(starts, unpack_blocks(few.column("data").to_pylist(), decoder)):
                    ends = np.cumsum(n)
                    raw = ids.astype("<u4").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64()), pa.array(start + ends - n), pa.array(n),
                         pa.array([raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist())], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return blocks.select("part", "before", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def crc_table(ids: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what ``read_ids`` gives, by Spark's own crc32."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

