"""Joins and searches against brute force."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import common, decontaminate, filters, jaccard_join, multi_index

# ------------------------------------------------------------------------------- near copies


def plain_components(rows, k, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [(d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def near_copies(seed, n=90):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[draw.choice(words) for _ in range(draw.choice([3, 20, 60, 200]))] for _ in range(6)]
    rows = []
    for i in range(n):
        own = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 5])):
            own[draw.randrange(len(own))] = draw.choice(words)
        rows.append((i, " ".join(own) if draw.random() < 0.9 else " ".join(own).upper()))
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 500), (2, 4)])
def test_components_like_brute_force(documents, odd, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_copies(seed) + [(i if i is None else i + 1000, t) for i, t in odd]
    got = jaccard_join.join(documents(rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r)[:3] for r in got], key=key) == sorted(plain_components(rows, 4, 85), key=key)


def test_one_document_of_each_component_stays(documents, odd):
    rows = near_copies(3) + [(i if i is None else i + 1000, t) for i, t in odd]
    out = jaccard_join.first_of_each(documents(rows), 5, 80)
    assert out.columns == documents(rows).columns
    got = [r.doc_id for r in out.collect()]
    want = {d for d, _, c in plain_components(rows, 5, 80) if d == c and d is not None}
    assert {g for g in got if g is not None} == want and len(got) == len(set(got))


def test_few_pairs_of_a_large_group_are_checked(documents, monkeypatch):
    """Also where a pair that stood for many is refuted, blocks come together without all their pairs."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 25)
    draw = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    base = [draw.choice(words) for _ in range(160)]
    rows = []
    for i in range(200):
        own = list(base)
        for _ in range(draw.choice([1, 2, 3, 4, 5])):
            own[draw.randrange(len(own))] = draw.choice(words)
        rows.append((i, " ".join(own)))
    checked = []
    check = jaccard_join._check
    monkeypatch.setattr(jaccard_join, "_check", lambda texts, pairs, k, percent: checked.append(pairs.count()) or check(texts, pairs, k, percent))
    got = sorted(tuple(r)[:3] for r in jaccard_join.join(documents(rows)).collect())
    assert got == sorted(plain_components(rows, 4, 85))
    assert sum(checked) < 8 * len(rows), checked


def test_sets_take_no_table_of_their_own(documents, monkeypatch):
    labels = []
    write = common.written
    monkeypatch.setattr(common, "written", lambda df, label, rows=None: labels.append(label) or write(df, label, rows))
    rows = near_copies(5)
    assert sorted(tuple(r)[:3] for r in jaccard_join.join(documents(rows)).collect()) == sorted(plain_components(rows, 4, 85))
    assert "checked" in labels and "sets" not in labels


def test_groups_with_the_same_first_member_are_dealt_together(spark, monkeypatch):
    """Each group whole; those of large sets are spread."""
    monkeypatch.setattr(jaccard_join, "SPREAD", 1000)
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else small partitions become one
    members = [(k, d, n, d) for n, own in ((100, range(4)), (10**6, range(10, 14))) for k in range(n, n + 300) for d in own]
    members = spark.createDataFrame(members, "k long, d1 long, n long, c long")
    try:
        placed = jaccard_join._placed(members, 85)
        rows = jaccard_join._dealt(placed, 85).select("k", "size", "block", "first", F.spark_partition_id().alias("at")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    groups, tasks = Counter((r.k, r.size, r.block, r.at) for r in rows), defaultdict(set)
    for r in rows:
        tasks[r.first].add((r.size, r.at))
    assert set(groups.values()) == {4} and len(groups) == len({g[:3] for g in groups})
    assert len(tasks[0]) == len({size for size, _ in tasks[0]}) and len(tasks[10]) > len({size for size, _ in tasks[10]})


def test_two_forests_outlive_a_refuted_pair():
    sets = [np.arange(1, 101, dtype=np.uint64) << np.uint64(20)] * 30
    bins = jaccard_join.folded([jaccard_join.histogram(s).tobytes() for s in sets])
    tree = jaccard_join.Tree(np.full(30, 100), bins, np.arange(30))
    pairs = jaccard_join.walk(tree, tree, 85, True, 2)
    assert len(pairs) <= 2 * 29
    for lost in range(len(pairs)):
        reached = {0}
        for _ in pairs:
            reached |= {y for p in pairs[:lost] + pairs[lost + 1 :] if reached & set(p) for y in p}
        assert len(reached) == 30


def test_hashing_texts_takes_little_memory():
    text = pa.array([" ".join(f"w{i + j}" for j in range(500)) for i in range(2500)])
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    assert text.nbytes > 6 << 20
    jaccard_join._powers.cache_clear()
    tracemalloc.start()
    for _ in jaccard_join._sets(iter([batch]), 4):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20


def test_batches_of_few_rows(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    got, path = common.written(spark.range(100).coalesce(1).mapInArrow(sizes, "n long"), "few", 7)
    assert max(r.n for r in got.collect()) <= 7 and spark.conf.get(name) == before
    common.dropped(spark, path)


def test_stored_histograms_differ_no_more_than_sets():
    sizes = [100, 700, 1500, 1600, 3000, 20_000, 120_000, 130_000]
    sets = [np.unique(filters.mix(np.arange(k, k + n, dtype=np.uint64))) for k, n in enumerate(sizes)]
    raw = [jaccard_join.packed(jaccard_join.histogram(s)) for s in sets]
    assert [len(r) for r in raw] == [128, 128, 128, 256, 256, 2048, 16384, 16384]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            x, y = jaccard_join.unpacked([raw[i], raw[j]])
            assert np.abs(x - y).sum(dtype=np.int64) <= len(np.setxor1d(a, b))


def test_no_documents_no_components(documents):
    assert jaccard_join.join(documents([])).count() == 0
    assert jaccard_join.join(documents([(1, None), (2, "")])).count() == 2


def test_walk_loses_no_similar_pair():
    draw = random.Random(4)
    for percent in (50, 85):
        base = [frozenset(draw.sample(range(3000), draw.randint(5, 60))) for _ in range(5)]
        sets = []
        for _ in range(60):
            s = set(draw.choice(base))
            for _ in range(draw.randint(0, 8)):
                s.discard(draw.choice(sorted(s)))
                s.add(draw.randrange(3000))
            sets.append(np.array(sorted(filters.mix(np.array(sorted(s), np.uint64)))))
        bins = jaccard_join.folded([jaccard_join.histogram(s).tobytes() for s in sets])
        tree = jaccard_join.Tree(np.array([len(s) for s in sets]), bins, np.arange(60))
        got = {frozenset(p) for p in jaccard_join.walk(tree, tree, percent, True, False)}
        want = {frozenset((i, j)) for i in range(60) for j in range(i) if jaccard_join.linked(sets[i], sets[j], percent)}
        assert want <= got
        forest = jaccard_join.walk(tree, tree, percent, True, True)
        assert len(forest) < 60


def test_shingles_of_any_bytes():
    draw = random.Random(1)
    parts = [b"a", b"B", b"\x00", b" ", b"\t", b"\x0b", "é".encode(), b"xyz ", b"\x1c"]
    texts = [b"".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(1000)]
    sizes = np.array([len(t) for t in texts])
    gap = bytes(common.PAD)
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    starts = common.PAD + np.concatenate([[0], np.cumsum(sizes + common.PAD)[:-1]])
    alone = [jaccard_join.shingle_sets(*lone, 4)[0].tolist() for lone in (
        (np.frombuffer(gap + t + gap, np.uint8), np.array([common.PAD]), np.array([len(t)])) for t in texts[:50])]
    assert alone == [s.tolist() for s in jaccard_join.shingle_sets(data, starts, sizes, 4)[:50]]
    named = {}
    for text, got in zip(texts, jaccard_join.shingle_sets(data, starts, sizes, 4)):
        w = text.lower().split()
        want = frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
        assert len(got) == len(want) and named.setdefault(want, got.tolist()) == got.tolist()
    assert len({tuple(v) for v in named.values()}) == len(named)


def test_histograms_differ_no_more_than_sets():
    draw = random.Random(2)
    for _ in range(200):
        a, b = (np.array(sorted(draw.sample(range(500), draw.randint(1, 300))), np.uint64) for _ in range(2))
        a, b = np.unique(filters.mix(a)), np.unique(filters.mix(b))
        least = np.abs(jaccard_join.histogram(a).astype(int) - jaccard_join.histogram(b)).sum()
        assert least <= len(np.setxor1d(a, b))
    sizes = [100, 1500, 1600, 3000, 3100, 20_000, 120_000]
    sets = [np.unique(filters.mix(np.arange(k, k + n, dtype=np.uint64))) for k, n in enumerate(sizes)]
    raw = [jaccard_join.histogram(s).tobytes() for s in sets]
    assert [len(r) for r in raw] == [256, 256, 512, 512, 1024, 4096, 16384]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            x, y = jaccard_join.folded([raw[i], raw[j]])
            assert len(x) == min(len(raw[i]), len(raw[j]))
            assert np.abs(x - y).sum(dtype=np.int64) <= len(np.setxor1d(a, b))


def test_connected_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -------------------------------------------------------------------------------- benchmark


def plain_matches(docs, items, k=5, least=0.8):
    def runs(text):
        w = (text or "").lower().split()
        return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]

    out = {}
    for item_id, text in items:
        own = Counter(runs(text))
        for doc_id, doc in docs:
            s = runs(doc)
            n = min(len(s), sum(own.values()))
            for a in range(len(s) - n + 1) if n else ():
                shared = sum((Counter(s[a : a + n]) & own).values())
                value = shared / (n + sum(own.values()) - shared)
                if value >= least and value > out.get((doc_id, item_id), (0,))[0]:
                    out[doc_id, item_id] = value, a
    return out


def test_benchmark_items_are_found(spark, documents, odd):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    prose = lambda n: [draw.choice(words) for _ in range(n)]
    items = [(i, " ".join(prose(draw.randint(15, 50)))) for i in range(20)] + [(90, None), (91, ""), (92, "only four words here"), (93, "la " * 20)]
    rows = []
    for i in range(80):
        own = prose(draw.randint(5, 120))
        if i % 2:
            passage = draw.choice(items[:20])[1].split()
            for _ in range(draw.choice([0, 0, 1, 2])):
                passage[draw.randrange(len(passage))] = "changed"
            at = draw.randint(0, len(own))
            own[at:at] = passage[: draw.choice([len(passage), len(passage), len(passage) // 2])]
        rows.append((i, " ".join(own)))
    rows += [(200, " ".join(items[3][1].split()[:-1])), (201, "la " * 40)] + [(i if i is None else i + 1000, t) for i, t in odd]
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.contaminated(documents(rows), table).collect()}
    assert got == plain_matches(rows, items)


def test_benchmark_items_in_another_order_are_found(spark, documents):
    draw = random.Random(8)
    prose = lambda n: [f"v{draw.randrange(3000)}" for _ in range(n)]
    items, rows = [], []
    for i in range(24):
        item = prose(draw.randint(60, 90))
        if i % 4 == 3:  # shingles that recur in the item
            item[20:20] = item[5:13]
        cut = len(item) // 2 + draw.randint(-10, 10)
        items.append((i, " ".join(item)))
        rows.append((i, " ".join(prose(60) + item[cut:] + item[:cut] + prose(60))))
        rows.append((100 + i, " ".join(item[cut:] + prose(1) + item[:cut] + item[cut:] + prose(9))))
    items.append((None, " ".join(prose(50))))
    rows.append((300, " ".join(prose(9) + items[-1][1].split()[25:] + items[-1][1].split()[:25])))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.contaminated(documents(rows), table).collect()}
    want = plain_matches(rows, items)
    assert got == want and {(i, i) for i in range(24)} | {(300, None)} <= set(want)


def test_benchmark_edges(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    assert decontaminate.contaminated(documents([(1, "a b c d e f")]), none).count() == 0
    assert decontaminate.contaminated(documents([]), one).count() == 0
    same = documents([(1, "a b c d e f g h i j k l m n o p")] * 3)
    assert [r.similarity for r in decontaminate.contaminated(same, one).collect()] == [1.0]


def test_blocks_of_a_large_benchmark(spark, documents, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(12)]
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 50)
    got = decontaminate.contaminated(documents(items), table).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(12)]


def test_only_functions_run(spark, documents):
    one = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    plan = decontaminate.contaminated(documents([(1, "a b c d e f g h")]), one)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_fingerprint_is_a_majority(spark):
    hashes = [5, -7, 123456789, -1]
    row = spark.range(1).select(decontaminate.simhash(F.array(*[F.lit(h).cast("bigint") for h in hashes])).alias("p")).first()
    want = sum(1 << b for b in range(64) if sum(1 if (h >> b) & 1 else -1 for h in hashes) > 0)
    assert row.p % 2**64 == want


# -------------------------------------------------------------------------------- neighbours


def plain_nearest(rows, asks, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in good:
        if asks(q):
            scored = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, score string, rank int")


def test_small_tables_are_searched_whole(spark):
    draw = np.random.default_rng(1)
    rows = [(i, np.float32(draw.normal(size=6)).tolist()) for i in range(120)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # equal vectors: ties by id
    rows += [(300, None), (301, [0.0] * 6), (302, [math.nan] * 6), (303, [math.inf] * 6), (304, [None] * 6), (305, []), (None, rows[0][1])]
    rows += [rows[3], (306, [1.0, 2.0])]
    got = defaultdict(list)
    for r in multi_index.search(vectors(spark, rows), F.col("vec_id") % 5 == 0, k=8).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = plain_nearest([r for r in rows if r[0] != 306], lambda q: q % 5 == 0, 8)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_fewer_candidates_than_wanted(spark):
    rows = [(0, [1.0, 0.0]), (5, [0.5, 0.5])]
    got = multi_index.search(vectors(spark, rows), F.col("vec_id") % 5 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 5, 0.5), (5, 1, 0, 0.5)]
    assert multi_index.search(vectors(spark, []), F.lit(True)).count() == 0


def test_walk_is_in_order_of_the_sum():
    draw = np.random.default_rng(2)
    left, right = draw.normal(size=7), draw.normal(size=5)
    way = multi_index.walk(left, right, np.ones((7, 5), int), 10**9)
    sums = [left[i] + right[j] for i, j in way]
    assert len(set(way)) == 35 and sums == sorted(sums, reverse=True)
    assert len(multi_index.walk(left, right, np.full((7, 5), 3), 10)) == 4


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "LEAST", 100)
    draw = np.random.default_rng(3)
    rows = [(i, np.float32(draw.normal(size=16)).tolist()) for i in range(2000)]
    got = defaultdict(set)
    for r in multi_index.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=10).collect():
        got[r.query_id].add(r.vec_id)
    want = plain_nearest(rows, lambda q: q % 20 == 0, 10)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
