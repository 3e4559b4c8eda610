"""Merge-type SentencePiece encoding by a prefix table, and decoding.

For each prefix of a text the table holds the one token that ends its encoding. A token t ending
at i is that token exactly if t and the last token of the prefix before it keep apart when the
two are merged by themselves: merges inside a token never depend on what lies beyond its
neighbours. Candidates come from an automaton over all pieces; the tests of pairs are remembered.
The ids are then read off backwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridlake.llm import common
from gridlake.llm.units import UnitCache, kept

SPACE = "▁"  # stands for a space in pieces: a fixed value of the format
START = -1
#: Pairs remembered in a worker; tests beyond are repeated.
PAIRS_KEPT = 1_000_000
#: Bytes of texts that a task encodes at once: their words and ids are Python objects meanwhile.
ENCODED_BYTES = 1 << 19


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.bytes = {}
        self.pieces: dict[str, tuple[float, int]] = {}
        self.text: list[str] = [""] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces[piece] = (sp.get_score(i), i)
                self.text[i] = piece
        self.automaton = ahocorasick.Automaton()
        for piece, (_, i) in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.size = size
        self.apart: dict[int, bool] = {}
        self.cache = UnitCache(self._encode_units)

    def merge(self, text: str) -> list[int]:
        """The definition, for short strings of known characters: always merge the adjacent pair
        whose joined piece scores highest, the leftmost of equals."""
        symbols = list(text)
        while True:
            best = None
            for k in range(len(symbols) - 1):
                found = self.pieces.get(symbols[k] + symbols[k + 1])
                if found and (best is None or found[0] > best[0]):
                    best = (found[0], k)
            if best is None:
                return [self.pieces[s][1] for s in symbols]
            k = best[1]
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]

    def keeps_apart(self, a: int, b: int) -> bool:
        key = (a + 1) * self.size + b
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= PAIRS_KEPT:
                self.apart.clear()
            if a == START:
                known = self.merge(self.text[b]) == [b]
            else:
                known = self.merge(self.text[a] + self.text[b]) == [a, b]
            self.apart[key] = known
        return known

    def encode_unit(self, text: str) -> list[int]:
        """Ids of one normalised unit. A character without a piece becomes its bytes and starts
        the table anew, since nothing merges across it."""
        n = len(text)
        last, size = [START] * (n + 1), [0] * (n + 1)
        apart, width = self.apart, self.size
        for end, (length, token) in self.automaton.iter(text):
            at = end + 1 - length
            if size[end + 1]:
                continue
            before = last[at]
            known = apart.get((before + 1) * width + token)
            if known is None:
                known = self.keeps_apart(before, token)
            if known:
                last[end + 1], size[end + 1] = token, length
        out: list[int] = []
        i = n
        while i:
            if size[i]:
                out.append(last[i])
                i -= size[i]
            else:
                out.extend(self.bytes[b] for b in reversed(text[i - 1].encode()))
                i -= 1
        out.reverse()
        return out

    def _encode_units(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        ids = [self.encode_unit(SPACE + u.replace(" ", SPACE)) for u in units]
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        return units, flat, np.fromiter(map(len, ids), np.int64, len(ids)), np.zeros(len(ids))

    @staticmethod
    def units(text: str) -> list[str]:
        """Words, each standing for itself with the space before it; further spaces before it
        are kept. No piece has a space behind another character, so no merge crosses these."""
        if not text:
            return []
        parts = text.replace(SPACE, " ").split(" ")
        if "" not in parts:
            return parts
        out, spaces = [], 0
        for part in parts[:-1]:
            if part:
                out.append(" " * spaces + part)
                spaces = 0
            else:
                spaces += 1
        return [*out, " " * spaces + parts[-1]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.units(t) for t in texts]
        ids, each = self.cache.flat(self.cache.rows([u for own in parts for u in own]))
        upto = np.append(0, np.cumsum(each))
        ends = upto[np.cumsum([len(p) for p in parts])] if parts else []
        return np.split(ids, ends[:-1]) if parts else []

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def encode_decode(docs: DataFrame, model: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode every text and decode it again.

    Returns one row per document: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas), decoded_sha256 (of the decoded text in UTF-8), and of ids and decoded those in ``keep``.
    NULL and empty texts have no ids and decode to an empty text. Repeated rows and NULL ids give
    one row each; other columns are ignored. No shuffle: each row is worked on where it is read."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * ("ids" in keep) + ", decoded string" * ("decoded" in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("pieces", model), lambda: Codec(model))
        names = [str(i) for i in range(codec.size)]
        for part, *_ in common.buffers(batches, "text", ENCODED_BYTES):
            encoded = codec.encode([t or "" for t in part.column("text").to_pylist()])
            lists = [x.tolist() for x in encoded]
            decoded = [codec.decode(x) if x else "" for x in lists]
            columns = {
                "doc_id": part.column("doc_id"),
                "n_tokens": pa.array([len(x) for x in lists], pa.int64()),
                "ids_sha256": pa.array([common.sha256(",".join([names[i] for i in x]).encode()) for x in lists], pa.string()),
                "decoded_sha256": pa.array([common.sha256(t.encode()) for t in decoded], pa.string()),
            }
            if "ids" in keep:
                columns["ids"] = pa.array(encoded, pa.list_(pa.int32()))
            if "decoded" in keep:
                columns["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select("doc_id", "text").mapInArrow(run, schema)
