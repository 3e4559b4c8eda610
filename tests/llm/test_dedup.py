"""Substring operators against plain versions of what they compute."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridlake.llm import chunk_dedup, common, filters, suffix_dedup


def covered(texts, length):
    """Runs of bytes covered by a string of ``length`` bytes that starts more than once."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        spans = [(i, i + length) for i in range(len(r) - length + 1) if seen[r[i : i + length]] > 1]
        out.append((r, common.merged(spans)))
    return out


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgé") for _ in range(draw.randint(1, 9))) for _ in range(200)]
    prose = lambda k: " ".join(draw.choice(words) for _ in range(k))
    passages = [prose(draw.randint(50, 130)) for _ in range(4)]
    rows = []
    for i in range(n):
        text = prose(draw.randint(1, 150))
        if draw.random() < 0.5:
            text += " " + draw.choice(passages) + " " + prose(draw.randint(0, 40))
        if draw.random() < 0.2 and rows:
            text = draw.choice(rows)[1]
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("gathered", [200, 2])
def test_repeats_like_brute_force(documents, odd, monkeypatch, gathered):
    monkeypatch.setattr(suffix_dedup, "GATHERED", gathered)
    monkeypatch.setattr(suffix_dedup, "SHARD_ROWS", 2000)
    rows = corpus(1) + [(i if i is None else i + 1000, t) for i, t in odd]
    got = suffix_dedup.remove_repeats(documents(rows), keep=True).collect()
    assert len(got) == len(rows)
    want = []
    for (doc_id, _), (raw, runs) in zip(rows, covered([t for _, t in rows], 400)):
        kept = common.without(raw, runs)
        want.append((doc_id, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(*r[:5], bytes(r.kept)) for r in got], key=key) == sorted(want, key=key)


def test_short_passages_are_told(documents):
    """51 words that recur, in texts of their own otherwise, each at another place."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9)))
    passage = " ".join(word() for _ in range(51))
    assert 219 <= len(passage) < 400
    own = lambda: " ".join(word() for _ in range(draw.randint(60, 300)))
    rows = [(i, f"{own()} {passage} {own()}" if i % 2 else f"{own()} {own()}") for i in range(80)] + [(100, None), (101, passage[:150])]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(documents(rows)).collect()}
    assert all((got[i].n_shared > 0) == bool(i % 2) for i in range(80)) and got[100].n_shared == got[101].n_shared == 0
    assert all(r.n_removed == 0 for r in got.values())


def test_hashing_texts_takes_little_memory():
    text = pa.array([" ".join(f"w{i + j}" for j in range(500)) for i in range(2500)])
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    assert text.nbytes > 6 << 20
    tracemalloc.start()
    for _, data, starts, lengths in suffix_dedup.slices(iter([batch])):
        suffix_dedup.anchors(data, starts, lengths, suffix_dedup.LENGTH, suffix_dedup.WIDTH)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20


def test_anchors_are_found_without_a_row_for_each_start():
    text = pa.array([" ".join(f"w{i + j}" for j in range(500)) for i in range(400)])
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    tracemalloc.start()
    for _, data, starts, lengths in suffix_dedup.slices(iter([batch])):
        row, first, many, at = suffix_dedup.anchors(data, starts, lengths, suffix_dedup.LENGTH, suffix_dedup.WIDTH)
        assert many.sum() == (lengths - suffix_dedup.LENGTH + 1).sum()
        assert (first <= at).all() and (at < first + suffix_dedup.WIDTH).all() and (np.diff(row) >= 0).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18 << 20


def test_repeats_of_an_empty_table(documents):
    assert suffix_dedup.remove_repeats(documents([])).count() == 0


def test_transforms_find_repeats():
    draw = random.Random(3)
    for _ in range(30):
        length, block = draw.choice([(8, 2), (12, 4), (40, 10)])
        base = bytes(draw.choice(b"ab") for _ in range(3 * length))
        contexts, many, weight = [], [], []
        for _ in range(draw.randint(1, 25)):
            m, at = draw.randint(1, length), draw.randrange(len(base))
            text = bytearray((base * 3)[at : at + m + length - 1])
            text[draw.randrange(len(text))] = draw.choice(b"abc")
            contexts.append(bytes(text)), many.append(m), weight.append(draw.choice([1, 1, 2]))
        seen = Counter()
        for c, m, w in zip(contexts, many, weight):
            for i in range(m):
                seen[c[i : i + length]] += w
        want = [seen[c[i : i + length]] > 1 for c, m in zip(contexts, many) for i in range(m)]
        got = suffix_dedup.repeated_starts(contexts, np.array(many), np.array(weight), length, block)
        assert got.tolist() == want


def test_interleaving_is_the_sorted_order():
    """Merging two shards gives the order and the common prefixes of sorting both."""
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab") for _ in range(12)) for _ in range(6)]

    def shard(own, base):
        previous, before, ending = [], [], []
        for t in own:
            at = len(previous)
            for i in range(len(t) + 1):
                previous.append(at + i - 1 if i else -1)
                before.append(ord(t[i - 1]) if i else -1)
                ending.append(i == len(t))
        return suffix_dedup.shard_transform(np.array(previous), np.array(before), np.array(ending), base, 5), len(previous)

    a, size = shard(texts[:3], 0)
    b, _ = shard(texts[3:], size)
    merged, prefix = suffix_dedup.interleave(a, b, 5)
    suffixes = [t[i:] for t in texts for i in range(len(t) + 1)]
    heads = [suffixes[i][:5] for i in merged.order]
    assert heads == sorted(heads)
    for k in range(1, len(heads)):
        shared = next((j for j in range(5) if heads[k - 1][j : j + 1] != heads[k][j : j + 1]), 5)
        if len(suffixes[merged.order[k]]) >= 5 or len(suffixes[merged.order[k - 1]]) >= 5:
            assert prefix[k] == shared


def plain_gear(data):
    h, out = 0, []
    for byte in data:
        h = ((h << 1) + int(chunk_dedup.GEAR[byte])) & 0xFFFFFFFF
        out.append(h)
    return out


def test_gear_hash_rolls():
    data = np.frombuffer(random.Random(1).randbytes(300), np.uint8)
    assert chunk_dedup.gear_hash(data).tolist() == plain_gear(data.tolist())


def test_cuts_survive_an_insertion():
    draw = random.Random(2)
    text = "".join(draw.choice("abcdefgh ") for _ in range(4000)).encode()
    longer = text[:1500] + b"inserted here" + text[1500:]

    def pieces(raw):
        data = np.frombuffer(bytes(common.PAD) + raw + bytes(common.PAD), np.uint8)
        _, start, size = chunk_dedup.chunks(data, np.array([common.PAD]), np.array([len(raw)]), chunk_dedup.RADIUS, 4096)
        assert start.tolist() == [0, *(start + size).tolist()[:-1]] and (start + size)[-1] == len(raw)
        return {raw[a : a + n] for a, n in zip(start.tolist(), size.tolist())}

    assert len(pieces(text) - pieces(longer)) <= 4


def test_cutting_texts_takes_little_memory(spark):
    class Tasks:  # hands back what a task would run
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    text = pa.array([" ".join(f"w{i + j}" for j in range(500)) for i in range(2500)])
    number = pa.array(range(len(text)), pa.int64())
    batch = pa.RecordBatch.from_arrays([number, text, number], ["doc_id", "text", "th"])
    assert text.nbytes > 6 << 20
    run = chunk_dedup.chunk_table(Tasks())
    tracemalloc.start()
    for _ in run(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


@pytest.mark.parametrize("full", [False, True])
def test_a_full_filter_changes_no_chunk(documents, monkeypatch, full):
    if full:
        every = np.full(1 << (filters.FILTER_BITS - 6), 2**64 - 1, np.uint64)
        monkeypatch.setattr(chunk_dedup, "fixed_filter", lambda *_: every)
    rows = corpus(5)
    seen, want = {}, {}
    for doc_id, text in rows:
        raw = text.encode()
        data = np.frombuffer(bytes(common.PAD) + raw + bytes(common.PAD), np.uint8)
        _, start, size = chunk_dedup.chunks(data, np.array([common.PAD]), np.array([len(raw)]), chunk_dedup.RADIUS, chunk_dedup.MAX_CHUNK)
        pieces = [raw[a : a + n] for a, n in zip(start.tolist(), size.tolist())]
        want[doc_id] = (len(pieces), sum(p in seen or bool(seen.setdefault(p, ())) for p in pieces))
    got = chunk_dedup.dedup_chunks(documents(rows)).collect()
    assert {r.doc_id: (r.n_chunks, r.n_repeated) for r in got} == want


def test_chunks_keep_first_occurrences(documents, odd):
    rows = corpus(4) + [(i if i is None else i + 1000, t) for i, t in odd]
    got = chunk_dedup.dedup_chunks(documents(rows)).collect()
    assert len(got) == len(rows)
    # The same by a loop over the documents in order.
    chunk = {}
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    want = {}
    for none, doc_id, text in order:
        raw = text.encode()
        data = np.frombuffer(bytes(common.PAD) + raw + bytes(common.PAD), np.uint8)
        _, start, size = chunk_dedup.chunks(
            data, np.array([common.PAD]), np.array([len(raw)]), chunk_dedup.RADIUS, chunk_dedup.MAX_CHUNK
        )
        spans = [(a, a + n) for a, n in zip(start.tolist(), size.tolist()) if raw[a : a + n] in chunk or chunk.setdefault(raw[a : a + n], 0)]
        runs = [r for r in common.merged(spans) if r[1] - r[0] >= chunk_dedup.MIN_RUN]
        want[None if none else doc_id, len(raw)] = ",".join(f"{a}:{b}" for a, b in runs), len(start)
    for r in got:
        spans, n = want[r.doc_id, r.n_bytes]
        assert r.n_chunks == n and r.n_removed == sum(int(s.split(":")[1]) - int(s.split(":")[0]) for s in r.spans.split(",") if s)
        if r.doc_id is not None and not (r.n_bytes == 50 and r.doc_id > 1000):
            assert r.spans == spans
    assert chunk_dedup.dedup_chunks(documents([])).count() == 0


def test_short_copies_go(documents):
    short = ["Hello.", "a line of less than a chunk", "a text of about one hundred bytes, which has a cut or two in it, all of which recurs in others"]
    rows = [(10 * i + j, text) for i, text in enumerate(short) for j in range(3)]
    got = {r.doc_id: r for r in chunk_dedup.dedup_chunks(documents(rows)).collect()}
    for i, text in enumerate(short):
        assert got[10 * i].text == text and got[10 * i].n_removed == 0
        for j in (1, 2):
            r = got[10 * i + j]
            assert (r.text, r.n_removed, r.kept_in) == ("", len(text), [10 * i])


def test_short_passages_lose_every_chunk_that_recurs(documents):
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefghilmnorstu") for _ in range(draw.randint(2, 8))) for _ in range(2000)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    rows = []
    for i in range(150):
        passage = prose(51)
        rows += [(2 * i + j, " ".join([prose(draw.randint(5, 80)), passage, prose(draw.randint(5, 80))])) for j in (0, 1)]
    got = {r.doc_id: r for r in chunk_dedup.dedup_chunks(documents(rows)).collect()}

    def names(text):
        raw = text.encode()
        data = np.frombuffer(bytes(common.PAD) + raw + bytes(common.PAD), np.uint8)
        _, start, size = chunk_dedup.chunks(data, np.array([common.PAD]), np.array([len(raw)]), chunk_dedup.RADIUS, chunk_dedup.MAX_CHUNK)
        return [raw[a : a + n] for a, n in zip(start.tolist(), size.tolist())]

    seen, short = set(), 0
    for i, (doc_id, text) in enumerate(rows):
        gone = 0
        for c in names(text):
            gone += len(c) if c in seen else 0
            seen.add(c)
        short += i % 2 and 0 < gone < 120
        assert got[doc_id].n_removed == gone
    assert short and sum(got[2 * i + 1].n_removed >= 29 for i in range(150)) >= 140


def test_a_long_run_of_one_byte_is_cut():
    data = np.frombuffer(bytes(common.PAD) + b"x" * 20_000 + bytes(common.PAD), np.uint8)
    _, start, size = chunk_dedup.chunks(data, np.array([common.PAD]), np.array([20_000]), chunk_dedup.RADIUS, 4096)
    assert size.max() <= 4096 and size.sum() == 20_000
