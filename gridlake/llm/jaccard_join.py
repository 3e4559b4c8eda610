"""Exact join of documents on the Jaccard similarity of their word shingles.

Equal sets are one class from the start. Two classes can only be similar if they share one of
their rarest shingles (the prefix of each set, in one order of all shingles), so classes meet in
groups by such a shingle. In a group, a signature tree over the members holds in each node the
union of the members' token bitmaps and the range of their sizes; walking two trees against each
other drops pairs of nodes whose members cannot overlap enough. What remains is checked on the
sets themselves.

The bitmaps come from a histogram of each set, which at the leaves of the walk rules out nearly
all pairs that are not similar, before any pair leaves its task.

Links are wanted for components, so pairs that are connected already are dropped too. A first walk
takes what may be similar as linked at once and gives no more pairs than a forest over a group; those
are checked. Where all of them hold, the forest connects what a full walk would, and the group is done.
Groups with a refuted pair, or of several blocks, are walked by their components for two forests, and
those with a refuted pair then once more in full. Members meet only where their sizes can link, and in
blocks, so no task holds a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common, units
from gridlake.llm.filters import MIX_1, fixed_filter, in_filter, mix

WORDS = 4
PERCENT = 85
#: Bins of a class's histogram, and bits of its token bitmap: the bins that are not empty. Two sets
#: differ in no fewer shingles than their histograms do. Large sets have 2, 4, ... times as many bins,
#: so that one holds PER_BIN shingles or fewer on average, up to MOST_BINS; halves added up give the
#: histogram of half as many bins.
BINS, PER_BIN, MOST_BINS, FEW = 256, 6, 1 << 14, 15
#: Members of a node that is not split further: all its pairs are looked at together.
LEAF = 24
#: Members of a group that one walk takes on each side.
BLOCK = 500
#: Shingles of a set for each task that its groups are dealt to.
SPREAD = 4096
#: Forests that the walk by components gives: a component comes apart from its group only where the pairs of
#: all of them are refuted. None gives every pair.
FORESTS = 2
#: log2 of the counters of the frequency sketch that orders shingles; any order is right, this one
#: keeps groups small.
SKETCH_BITS = 20
#: Bytes of texts that a task hashes at once: each takes some fifty bytes of a worker meanwhile. And rows that
#: go to Python and back at once.
SLICE, ROWS = 1 << 19, 1000


#: A random-looking 64-bit value for each byte, A-Z as in lower case; and what is white space.
BYTE = np.array([xxhash.xxh64_intdigest(bytes([i]).lower(), 13) for i in range(256)], np.uint64)
BLANK = np.array([bytes([i]).isspace() for i in range(256)])
BASE = np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE, and of its inverse modulo 2**64."""
    out = []
    for base in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
        power = np.full(size, base)
        power[0] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


def shingle_sets(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of the texts of a buffer.

    A-Z count as lower case; words lie between ASCII white space, or between the zeros that
    separate texts. Fewer words than ``k`` make one shingle; none make an empty set. All words of
    a buffer are hashed at once, as differences of one running sum."""
    # Texts may hold zero bytes themselves, so where texts lie decides, not the byte.
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + lengths, -1)
    solid = (np.cumsum(inside[:-1]) > 0) & ~BLANK[data]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    first, last = edge[::2], edge[1::2]
    power, inverse = _powers(1 << len(data).bit_length())
    sums = np.append(np.uint64(0), np.cumsum(BYTE[data] * power[: len(data)], dtype=np.uint64))
    w = mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    h = w.copy()
    for j in range(1, k):
        h[:-j] = h[:-j] * MIX_1 + w[j:]
    h = mix(h)
    lo, hi = np.searchsorted(first, starts), np.searchsorted(first, starts + lengths)
    out = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        if b - a >= k:
            own = np.sort(h[a : b - k + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif b > a:
            short = b - a
            for x in w[a:b].tolist():
                short = (short * int(MIX_1) + x) & (2**64 - 1)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_size(n: int, percent: int) -> int:
    """Similar sets share one of so many first shingles in any common order."""
    return n + 1 - -(-percent * n // 100) if n else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


# ------------------------------------------------------------------------------ signature trees


def histogram(own: np.ndarray) -> np.ndarray:
    """Shingles by bin, 255 at most: cutting both of two counts never widens their difference."""
    many = BINS
    while many < MOST_BINS and len(own) > PER_BIN * many:
        many *= 2
    return np.minimum(np.bincount((own >> np.uint64(20)).astype(np.int64) % many, minlength=many), 255).astype(np.uint8)


def folded(raw: list[bytes]) -> np.ndarray:
    """Histograms as rows of the smallest number of bins that any of them has."""
    many = min(map(len, raw), default=BINS)
    out = np.empty((len(raw), many), np.int16)
    for i, b in enumerate(raw):
        own = np.frombuffer(b, np.uint8)
        out[i] = own if len(own) == many else np.minimum(own.reshape(-1, many).sum(axis=0), 255)
    return out


def packed(bins: np.ndarray) -> bytes:
    """A histogram as it is stored: two bins a byte with ``FEW`` shingles at most in each, which is what bins
    rarely exceed; those of the largest sets, where more can lie in one, a byte each."""
    if len(bins) >= MOST_BINS:
        return bins.tobytes()
    few = np.minimum(bins, FEW)
    return (few[: len(few) // 2] | few[len(few) // 2 :] << 4).tobytes()


def unpacked(raw: list[bytes]) -> np.ndarray:
    """Stored histograms as rows like those of ``folded``, cut alike, so that none differ by the cut."""
    whole = []
    for b in raw:
        own = np.frombuffer(b, np.uint8)
        whole.append(own if len(own) >= MOST_BINS else np.concatenate([own & FEW, own >> 4]))
    out = folded(whole)
    return np.minimum(out, FEW) if any(len(b) < MOST_BINS for b in raw) else out


class Tree:
    """Binary tree over members sorted by size: in each node the union of bitmaps, the range of
    sizes, and the largest excess of a member's size over its bitmap's bits."""

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, component: np.ndarray):
        maps = np.packbits(bins > 0, axis=1)
        self.order = np.lexsort((maps[:, 0], sizes)) if len(sizes) else np.zeros(0, np.int64)
        self.sizes, self.component = sizes[self.order], component[self.order]
        self.maps, self.bins = maps[self.order], bins[self.order]
        self.excess = self.sizes - np.bitwise_count(self.maps).sum(axis=1)
        self.nodes: dict[tuple[int, int], tuple] = {}

    def node(self, lo: int, hi: int) -> tuple:
        known = self.nodes.get((lo, hi))
        if known is None:
            c = self.component[lo:hi]
            known = (
                np.bitwise_or.reduce(self.maps[lo:hi], axis=0), int(self.sizes[lo]), int(self.sizes[hi - 1]),
                int(self.excess[lo:hi].max()), int(c[0]) if (c == c[0]).all() else None,
            )
            self.nodes[lo, hi] = known
        return known


def walk(a: Tree, b: Tree, percent: int, same: bool, forests: int) -> list[tuple[int, int]]:
    """Pairs (member of a, member of b) that may be similar and lie in different components.

    ``same``: both trees are one, and each pair is wanted once. ``forests``: take every such
    pair as linked at once, so that no more than so many spanning forests of pairs come out; 0: every pair."""
    if not len(a.sizes) or not len(b.sizes):
        return []
    roots = [{c: c for c in np.unique(np.concatenate([a.component, b.component])).tolist()} for _ in range(forests)]

    def find(root: dict[int, int], x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out, todo = [], [(0, len(a.sizes), 0, len(b.sizes))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and b1 <= a0:
            continue
        map_a, low_a, high_a, over_a, whole_a = a.node(a0, a1)
        map_b, low_b, high_b, over_b, whole_b = b.node(b0, b1)
        if whole_a is not None and whole_a == whole_b:
            continue
        # The sizes nearest to each other decide whether any pair can be similar.
        small, large = (high_a, low_b) if high_a <= low_b else (high_b, low_a) if high_b <= low_a else (1, 1)
        if 100 * small < percent * large:
            continue
        bits = int(np.bitwise_count(map_a & map_b).sum())
        most = min(high_a, high_b, bits + min(over_a, over_b))
        if (100 + percent) * most < percent * (low_a + low_b):
            continue
        if forests:
            held = {*a.component[a0:a1].tolist(), *b.component[b0:b1].tolist()}
            if all(len({find(root, x) for x in held}) == 1 for root in roots):
                continue
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            both = a.sizes[a0:a1, None] + b.sizes[None, b0:b1]
            differ = np.abs(a.bins[a0:a1, None] - b.bins[None, b0:b1]).sum(axis=2, dtype=np.int64)
            near = ((100 + percent) * differ <= (100 - percent) * both) & (a.component[a0:a1, None] != b.component[None, b0:b1])
            if same:
                near &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None]
            x, y = np.nonzero(near)
            if forests:
                for k in np.argsort(differ[x, y] / both[x, y], kind="stable").tolist():  # the likest first
                    i, j = a0 + int(x[k]), b0 + int(y[k])
                    for root in roots:
                        p, q = find(root, int(a.component[i])), find(root, int(b.component[j]))
                        if p != q:
                            root[p] = q
                            out.append((int(a.order[i]), int(b.order[j])))
                            break
            else:
                out += zip(a.order[a0 + x].tolist(), b.order[b0 + y].tolist())
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            todo += [(a0, mid, b0, b1), (mid, a1, b0, b1)]
        else:
            mid = (b0 + b1) // 2
            todo += [(a0, a1, b0, mid), (a0, a1, mid, b1)]
    return out


# ------------------------------------------------------------------------------------- operator


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    return common.written(df, label, ROWS)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    raw = b"".join([xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) for s in sets])
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


def _sets(batches: Iterator[pa.RecordBatch], k: int):
    for part, data, starts, lengths in common.buffers(batches, "text", SLICE):
        sets = shingle_sets(data, starts, lengths, k)
        yield part, sets, _digests(sets)


def join(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash): the number of distinct shingles of each
    document, the smallest doc_id that links reach from it, itself included, and xxhash64 of the
    text, which tells rows of one id apart.

    Two documents link when 100 * shared >= ``percent`` * union of their shingles. NULL and empty
    texts, or texts without a word, have no shingle, link with nothing and are their own
    component. A NULL id never is the smallest; a component of NULL ids only has a NULL id.
    Repeated rows keep their rows and count once. Other columns are ignored. Shingles, and
    classes in links, are told apart by 64-bit hashes."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units.forget()
        counts, total = np.zeros(1 << SKETCH_BITS, np.int64), 0
        for part, sets, names in _sets(batches, k):
            for s in sets:
                np.add.at(counts, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                total += len(s)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names[:, 0].copy()),
                 part.column("th"), pa.array(np.full(n, -1), pa.int32()),
                 pa.array([packed(histogram(s)) if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "n", "d1", "th", "counter", "bins"],
            )
        # Counters well above the task's mean: those of frequent shingles.
        high = np.flatnonzero(counts > 8 + 4 * total / len(counts))
        none = pa.nulls(len(high), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, pa.array(counts[high]), none, none, pa.array(high, pa.int32()), pa.nulls(len(high), pa.binary())],
            ["doc_id", "n", "d1", "th", "counter", "bins"],
        )

    described = rows.mapInArrow(describe, "doc_id long, n long, d1 long, th long, counter int, bins binary")
    described, described_path = _written(described, "described")
    members = described.where("counter < 0")
    sketch = described.where("counter >= 0").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(1 << SKETCH_BITS, np.int64)
    frequency[sketch["counter"].to_numpy(np.int64)] = sketch["n"].to_numpy(np.int64)
    classes = members.where("n > 0").groupBy("d1").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.first("bins").alias("bins"))
    classes, classes_path = _written(classes, "classes")
    ordering = spark.sparkContext.broadcast(frequency)
    texts = rows.select("text")

    def speakers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """Each non-empty set once in a task, and its class."""
        seen: set[int] = set()
        for _, sets, names in _sets(batches, k):
            names = names[:, 0].tolist()
            on = [i for i, d in enumerate(names) if len(sets[i]) and not (d in seen or seen.add(d))]
            yield [sets[i] for i in on], np.array([names[i] for i in on], np.int64)

    def prefixes(sets: list[np.ndarray], frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([prefix_size(len(s), percent) for s in sets], np.int64)
        tokens = []
        for s, m in zip(sets, size.tolist()):
            hot = frequency[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            tokens.append(s[np.argsort(hot, kind="stable")[:m]])
        return np.repeat(np.arange(len(sets)), size), (np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)).view(np.int64)

    def emit_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets, d1 in speakers(batches):
            owner, token = prefixes(sets, ordering.value)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(d1[owner])], ["k", "d1"])

    tokens = texts.mapInArrow(emit_tokens, "k long, d1 long")
    grouped = tokens.groupBy("k").agg(F.min("d1").alias("a"), F.max("d1").alias("b")).where("a <> b").select("k")
    shared_tokens = spark.sparkContext.broadcast(fixed_filter(grouped, ROWS))

    def emit_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets, d1 in speakers(batches):
            owner, token = prefixes(sets, ordering.value)
            on = np.flatnonzero(in_filter(shared_tokens.value, token))
            owner, token = owner[on], token[on]
            sizes = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(d1[owner]), pa.array(sizes[owner])], ["k", "d1", "n"])

    found = texts.mapInArrow(emit_members, "k long, d1 long, n long").distinct()
    found, found_path = _written(found, "members")
    sizes = found.groupBy("k").agg(F.count("*").alias("m"), F.min("d1").alias("a"), F.max("d1").alias("b"), F.min("n").alias("low"), F.max("n").alias("high"), F.bit_xor(F.xxhash64("d1")).alias("who"))
    sizes, sizes_path = _written(sizes.where("m > 1"), "groups")
    couples = sizes.where((F.col("m") == 2) & (100 * F.col("low") >= percent * F.col("high"))).select("a", "b").distinct()
    couples, couples_path = _written(_near(couples, classes, percent), "couples")

    # Groups of three and more. Near copies meet under many shingles, always the same members: one
    # shingle stands for all.
    crowds = sizes.where("m > 2").groupBy("m", "a", "b", "who").agg(F.min("k").alias("k"))
    crowds, crowds_path = _written(crowds.select("k"), "crowds")
    crowd_keys = spark.sparkContext.broadcast(fixed_filter(crowds, ROWS))

    def in_crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(crowd_keys.value, batch.column("k").to_numpy())))

    # Most members met nobody, or one: a filter keeps them out of the shuffle.
    crowded, crowded_path = _written(found.mapInArrow(in_crowds, found.schema).join(crowds, "k"), "crowded")

    def with_bins(members: DataFrame) -> DataFrame:
        return members.join(classes.select("d1", "bins"), "d1")

    def first_walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for group in _runs(batches, ("k", "size", "block")):
            if group["more"][0]:  # pairs across blocks are left
                yield _unseen(group)
            names, component = np.array(group["d1"], np.int64), np.array(group["c"], np.int64)
            mark = xxhash.xxh3_128_digest(np.sort(names).tobytes())
            if mark in done or len(names) < 2:  # the same members met under another shingle
                continue
            done.add(mark)
            tree = Tree(np.array(group["n"]), unpacked(group["bins"]), component)
            yield _pairs(group, names, names, walk(tree, tree, percent, True, 1))

    def second_walk(forests: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in _runs(batches, ("k", "size", "ask", "held")):
                minor, held = np.array(group["minor"]), np.array(group["held_too"])
                names, n, c, bins = np.array(group["d1"], np.int64), np.array(group["n"]), np.array(group["c"], np.int64), unpacked(group["bins"])
                asks, others = Tree(n[minor], bins[minor], c[minor]), Tree(n[held], bins[held], c[held])
                yield _pairs(group, names[minor], names[held], walk(asks, others, percent, False, forests))

        return run

    def walked(members: DataFrame, keys: list[str], walk, more: list[str]) -> DataFrame:
        members = with_bins(members)
        dealt = (_dealt(members, percent) if "first" in members.columns else members.repartition(*keys)).sortWithinPartitions(*keys)
        return dealt.select(*keys, *more, "d1", "n", "c", "bins").mapInArrow(walk, _FOUND)

    # Rounds: what a walk takes as linked is checked, and groups where some of it is refuted are walked
    # again; the last walk gives every pair of different components.
    members_now, groups_now, scratch = crowded.withColumn("c", F.col("d1")), None, []
    tried, links, component = None, None, None
    for forests in (1, FORESTS, 0):
        if groups_now is None:
            found_now = walked(_placed(members_now, percent), ["k", "size", "block"], first_walk, ["more"])
        else:
            found_now = walked(_faced(members_now, groups_now, percent), ["k", "size", "ask", "held"], second_walk(forests), ["minor", "held_too"])
        found_now, path = _written(found_now, "found")
        scratch.append(path)
        fresh = found_now.where("a is not null").select("a", "b").distinct()
        fresh = couples.union(fresh).distinct() if tried is None else fresh.join(tried, ["a", "b"], "left_anti")
        fresh, path = _written(fresh, "candidates")
        scratch.append(path)
        if tried is None or not fresh.isEmpty():
            more, path = _written(_check(texts, fresh, k, percent), "checked")
            scratch.append(path)
            if links is None or not more.isEmpty():
                links = more if links is None else links.union(more)
                component, component_path = _written(common.components(links), "components")
                scratch.append(component_path)
        tried = fresh if tried is None else tried.union(fresh)
        if not forests:
            break
        c = component.select(F.col("node").alias("d1"), F.col("component").alias("c"))
        ends = tried
        for end in ("a", "b"):
            ends = ends.join(c.toDF(end, f"c_{end}"), end, "left").withColumn(f"c_{end}", F.coalesce(f"c_{end}", end))
        refuted = ends.where("c_a <> c_b").select("a", "b")
        again = found_now.join(refuted, ["a", "b"], "left_semi").union(found_now.where("a is null").select("a", "b", "k", "size"))
        groups_now, path = _written(again.select("k", "size").distinct(), "again")
        scratch.append(path)
        if groups_now.isEmpty():
            break
        some = crowded.join(groups_now.select("k").distinct(), "k", "left_semi")
        some = some.join(c, "d1", "left").withColumn("c", F.coalesce("c", "d1"))
        members_now, path = _written(some, "open")
        scratch.append(path)

    def labelled(df: DataFrame, name: str) -> DataFrame:
        c = component.select(F.col("node").alias(name), F.col("component").alias(f"c_{name}"))
        return df.join(c, name, "left").withColumn(f"c_{name}", F.coalesce(f"c_{name}", name))

    # Components by class, then the smallest id of each.
    known = labelled(classes, "d1")
    smallest = known.groupBy("c_d1").agg(F.min("first").alias("component_id"))
    named = known.join(smallest, "c_d1").select("d1", "component_id")
    out = members.join(named, "d1", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.col("th").alias("text_hash"))
    common.dropped(spark, found_path, sizes_path, crowds_path, crowded_path, couples_path, *[p for p in scratch if p != component_path])
    return out


def first_of_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id, and all columns.

    Of repeated rows one stays. Rows without an id stay if no row with an id is linked to them,
    one for each text."""
    kept = join(docs, k, percent).where("doc_id <=> component_id or component_id is null")
    id_name, text_name = common.spare("_key", docs.columns), common.spare("_th", docs.columns)
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    kept = kept.select(key.alias(id_name), F.col("text_hash").alias(text_name)).distinct()
    rows = docs.withColumns({id_name: key, text_name: F.xxhash64("text")})
    # The join deals rows out by id and text, so that dropping repeated ones moves none again.
    once = rows.join(kept, [id_name, text_name], "left_semi").dropDuplicates([id_name, text_name])
    return once.select(docs.columns)


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[dict[str, list]]:
    """Groups of rows that come sorted by ``keys``, as lists by column."""
    held: dict[str, list] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        marks = list(zip(*(columns[k] for k in keys)))
        cut = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
        for a, b in zip(cut, cut[1:]):
            part = {n: c[a:b] for n, c in columns.items()}
            if held is not None and all(held[k][0] == part[k][0] for k in keys):
                for n in held:
                    held[n] += part[n]
            else:
                if held is not None:
                    yield held
                held = part
    if held is not None:
        yield held


def _size_class(n: Column, percent: int) -> Column:
    """Sets that can be similar have the same size class or neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / percent) + 1e-9).cast("int")


def _shared_sizes(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members of groups (k, d1, n, c) by (k, size): those of a size class and of the one below it; and
    (k, size, m, main, first) of the classes where a pair may be open: with a member of their own, and
    of several components. ``main`` is the largest of those."""
    own = members.select("k", "d1", "n", "c", _size_class(F.col("n"), percent).alias("size"), F.lit(True).alias("own"))
    shared = own.unionByName(own.withColumns({"size": F.col("size") + 1, "own": F.lit(False)}))
    parts = shared.groupBy("k", "size", "c").agg(F.count("*").alias("many"), F.max("own").alias("own"), F.min("d1").alias("first"))
    counts = parts.groupBy("k", "size").agg(
        F.sum("many").alias("m"), F.count("*").alias("parts"), F.max("own").alias("own"), F.min("first").alias("first"), F.max(F.struct("many", "c")).alias("main")
    )
    return shared.drop("own"), counts.where("parts > 1 and own").select("k", "size", "m", F.col("main.c").alias("main"), "first", F.col("main.many").alias("most"))


def _placed(members: DataFrame, percent: int) -> DataFrame:
    """Members by (k, size, block) of bounded size. The member named first in a size class is in each of
    its blocks, so that blocks can become one component."""
    shared, counts = _shared_sizes(members, percent)
    sized = shared.join(counts, ["k", "size"]).withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    sized = sized.withColumn("more", F.col("blocks") > 1)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    mine = F.array(F.pmod(F.xxhash64("d1"), F.col("blocks")).cast("int"))
    return sized.withColumn("block", F.explode(F.when(F.col("d1") == F.col("first"), every).otherwise(mine))).select("k", "size", "block", "more", "first", "d1", "n", "c")


def _dealt(placed: DataFrame, percent: int) -> DataFrame:
    """Groups (k, size, block) whole, and those with the same first member in one task: near copies meet under many
    shingles in nearly the same company, so there the histograms of a class lie side by side and take
    little of the shuffle, and a company that was walked is known. A set has more shingles to meet under the
    larger it is, so groups of large sets are dealt by some bits of the shingle too."""
    spread = 1 + F.floor(F.pow(F.lit(100 / percent), F.col("size")) / SPREAD)
    return placed.repartition("first", "size", "block", F.pmod("k", spread))


def _faced(members: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Members of ``groups`` (k, size): those outside the main component of their size class against all of the class, as pairs of blocks
    (ask, held) of bounded size. ``minor`` tells who asks, ``held_too`` who is asked: where one block holds
    a whole class each member comes once, for both."""
    shared, counts = _shared_sizes(members, percent)
    counts = counts.join(groups, ["k", "size"], "left_semi")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    grid = counts.select("k", "size", "main", blocks(F.col("m") - F.col("most")).alias("n_asks"), blocks(F.col("m")).alias("n_held"))
    rows = shared.join(grid, ["k", "size"])
    block = lambda n: F.array(F.pmod(F.xxhash64("d1"), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    minor, one = F.col("c") != F.col("main"), F.col("n_held") == 1

    def placed(asks: Column, held: Column, minor: Column, held_too: Column) -> Column:
        pairs = F.transform(asks, lambda a: F.transform(held, lambda h: F.struct(a.alias("ask"), h.alias("held"), minor.alias("minor"), held_too.alias("held_too"))))
        return F.flatten(pairs)

    yes, no = F.lit(True), F.lit(False)
    places = F.when(one, placed(F.array(F.lit(0)), F.array(F.lit(0)), minor, yes)).otherwise(
        F.concat(F.when(minor, placed(block("n_asks"), every("n_held"), yes, no)).otherwise(placed(F.array().cast("array<int>"), every("n_held"), yes, no)), placed(every("n_asks"), block("n_held"), no, yes))
    )
    return rows.select("k", "size", "d1", "n", "c", F.inline(places))


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that their histograms don't rule out."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = (unpacked([x, y]) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()))
            differ = np.array([np.abs(p[0] - p[1]).sum(dtype=np.int64) for p in pairs], np.int64)
            on = (100 + percent) * differ <= (100 - percent) * batch.column("both").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(on))

    bins = pairs.join(classes.select(F.col("d1").alias("a"), F.col("n").alias("na"), F.col("bins").alias("x")), "a")
    bins = bins.join(classes.select(F.col("d1").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("y")), "b")
    return bins.select("a", "b", "x", "y", (F.col("na") + F.col("nb")).alias("both")).mapInArrow(near, "a long, b long")


#: A pair that a walk gives, and the group it met in; without a pair, a group that has to be walked again.
_FOUND = "a long, b long, k long, size int"


def _unseen(group: dict[str, list]) -> pa.RecordBatch:
    none = pa.nulls(1, pa.int64())
    return pa.RecordBatch.from_arrays([none, none, pa.array(group["k"][:1], pa.int64()), pa.array(group["size"][:1], pa.int32())], ["a", "b", "k", "size"])


def _pairs(group: dict[str, list], left: np.ndarray, right: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(pairs, np.int64).reshape(-1, 2)
    x, y = left[at[:, 0]], right[at[:, 1]]
    keep = x != y
    x, y = x[keep], y[keep]
    k, size = np.full(len(x), group["k"][0], np.int64), np.full(len(x), group["size"][0], np.int32)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(k), pa.array(size)], ["a", "b", "k", "size"])


def _check(rows: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar. Sets are made anew from the texts, for classes
    that a filter lets pass, and brought to the pairs by two joins. Both joins read the one shuffle by class
    that leaves each set once, so only the sets of ``a`` move again, with their pairs."""
    spark = rows.sparkSession
    wanted = spark.sparkContext.broadcast(fixed_filter(pairs.select(F.col("a").alias("k")).union(pairs.select("b")).distinct(), ROWS))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets, names in _sets(batches, k):
            d1 = names[:, 0]
            on = [i for i in np.flatnonzero(in_filter(wanted.value, d1)).tolist() if len(sets[i]) and not (d1[i] in seen or seen.add(d1[i]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d1[on]), pa.array([sets[i].astype("<u8").tobytes() for i in on], pa.binary())], ["d1", "own"]
            )

    sets = rows.mapInArrow(emit, "d1 long, own binary").groupBy("d1").agg(F.first("own").alias("own"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            yes = [linked(np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8"), percent) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(yes, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("d1").alias("a"), F.col("own").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("d1").alias("b"), F.col("own").alias("y")), "b")
    return with_b.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")
