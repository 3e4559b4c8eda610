"""Tokenizers against their libraries, files by round trip."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from gridlake.llm import common, huffman_ids, sentencepiece_codec
from gridlake.session import scratch_path

BPE, PIECES = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


def mixed(seed, n, alphabet):
    draw = random.Random(seed)
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 25))) for _ in range(n)]


def test_byte_bpe_like_the_library():
    encoder = huffman_ids.Encoder(BPE)
    texts = mixed(1, 4000, [" ", "a", "the", "\n", "\t", ".", "é", "'s", "12", " ", "　", "<|endoftext|>"])
    for text, ids in zip(texts, encoder.texts(texts)):
        assert ids.tolist() == encoder.library.encode(text, add_special_tokens=False).ids, repr(text)


def test_byte_bpe_looks_a_word_up_once():
    encoder = huffman_ids.Encoder(BPE)
    asked, rows = [], encoder.cache.rows
    encoder.cache.rows = lambda units, *more: asked.append(len(units)) or rows(units, *more)
    texts = ["a " + "one word and one more word \n " * 300] * 3
    want = encoder.library.encode(texts[0], add_special_tokens=False).ids
    assert all(ids.tolist() == want for ids in encoder.texts(texts))
    assert sum(asked) < 20
    assert encoder.cache.hits.sum() == 3 * len(texts[0].split(" "))


def test_ids_are_counted_while_texts_are_encoded(documents, odd):
    got = huffman_ids.encode_table(documents(odd), BPE).collect()
    texts = [r for r in got if r.id is None]
    want = np.bincount(np.concatenate([np.frombuffer(r.ids, huffman_ids.id_type(BPE)) for r in texts]))
    counts = np.zeros_like(want)
    for r in got:
        if r.id is not None:
            counts[r.id] += r.n
    assert len(texts) == len(odd) and counts.tolist() == want.tolist()


def test_pieces_like_the_library():
    codec = sentencepiece_codec.Codec(PIECES)
    draw = random.Random(2)
    names = sorted(codec.pieces)
    texts = mixed(3, 3000, list(" ab\nthe▁é執😀.") + ["  ", "ing", "\x00"])
    texts += ["".join(draw.choice(names) for _ in range(draw.randint(1, 8))) for _ in range(3000)]
    texts += [" " * k + "a" + " " * k for k in range(40)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == codec.library.encode(text), repr(text)


def test_code_is_optimal_and_limited():
    draw = np.random.default_rng(1)
    for limit, n in ((4, 9), (5, 20), (16, 300)):
        counts = draw.integers(1, 50, n) ** 3
        lengths = huffman_ids.code_lengths(counts, limit)
        assert lengths.max() <= limit and np.isclose((0.5 ** lengths.astype(float)).sum(), 1)
        codes = [format(int(c), f"0{b}b") for c, b in zip(huffman_ids.canonical(lengths), lengths)]
        assert not any(x != y and y.startswith(x) for x in codes for y in codes)
    # Without a binding limit the cost is Huffman's.
    import heapq

    counts = draw.integers(1, 1000, 40)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (counts * huffman_ids.code_lengths(counts, 30)).sum() == cost
    assert huffman_ids.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]


def test_blocks_are_read_back():
    draw = np.random.default_rng(2)
    documents = [draw.integers(0, 50, draw.integers(1, 400)).astype(np.uint32) for _ in range(20)]
    lengths = huffman_ids.code_lengths(np.bincount(np.concatenate(documents)))
    codes = huffman_ids.canonical(lengths)
    blocks = [huffman_ids.pack_block([None, i], documents[i : i + 2], codes, lengths) for i in range(0, 20, 2)]
    got = list(huffman_ids.unpack_blocks(blocks, huffman_ids.decode_table(lengths)))
    for i, (names, sizes, ids) in enumerate(got):
        assert names == [None, 2 * i] and ids.tolist() == np.concatenate(documents[2 * i : 2 * i + 2]).tolist()
        assert sizes.tolist() == [len(d) for d in documents[2 * i : 2 * i + 2]]


@pytest.mark.parametrize("block", [1, 1 << 17])
def test_token_files(spark, documents, odd, monkeypatch, block):
    monkeypatch.setattr(huffman_ids, "BLOCK_IDS", block)
    where = scratch_path(spark, "test")
    huffman_ids.write_ids(documents(odd), where, BPE)
    got = huffman_ids.crc_table(huffman_ids.read_ids(spark, where)).collect()
    library = Tokenizer.from_file(BPE)
    want = []
    for doc_id, text in odd:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    key = lambda r: (r[0] is not None, r[0] or 0, str(r[1:]))
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=key) == sorted(want, key=key)
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # ascending ids, NULL first, without gaps
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_token_files_of_an_empty_table(spark, documents):
    where = scratch_path(spark, "test")
    huffman_ids.write_ids(documents([]), where, BPE)
    assert huffman_ids.read_ids(spark, where).count() == 0


def test_sentencepiece_table(documents, odd):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sentencepiece_codec.encode_decode(documents(odd), PIECES, keep=("ids", "decoded")).collect()
    want = []
    for doc_id, text in odd:
        ids = sp.encode(text or "")
        decoded = sp.decode(ids) if ids else ""
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(decoded), ids, decoded))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)
    assert sentencepiece_codec.encode_decode(documents([]), PIECES).count() == 0


def test_few_texts_are_words_at_once(monkeypatch):
    class Rows:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    sizes, encode = [], sentencepiece_codec.Codec.encode
    monkeypatch.setattr(sentencepiece_codec.Codec, "encode", lambda codec, texts: sizes.append(sum(map(len, texts))) or encode(codec, texts))
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(25)), "text": ["a word " * 15_000] * 24 + [None]})
    got = [b for b in sentencepiece_codec.encode_decode(Rows(), PIECES)(iter([rows]))]
    assert max(sizes) <= 1 << 20 and sum(sizes) == 24 * 105_000
    counts = [n for b in got for n in b.column("n_tokens").to_pylist()]
    assert counts == [len(sentencepiece.SentencePieceProcessor(model_file=PIECES).encode("a word " * 15_000))] * 24 + [0]


def test_texts_that_are_encoded_are_not_joined_as_bytes(monkeypatch):
    """Slices hold every row once, in order, whatever the limit; and encoding makes no buffer of them."""
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "", "c" * 9, "é"])], ["text"])
    for limit in (1, 4, 100):
        got = list(common.slices(iter([batch]), "text", limit))
        assert [t for part, _ in got for t in part.column("text").to_pylist()] == ["ab", None, "", "c" * 9, "é"]
        assert [n for _, sizes in got for n in sizes.tolist()] == [2, 0, 0, 9, 2]
    names = {n for c in huffman_ids.encode_table.__code__.co_consts if hasattr(c, "co_names") for n in c.co_names}
    assert "slices" in names and "buffers" not in names
