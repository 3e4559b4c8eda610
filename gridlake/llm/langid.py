"""Language identification with unigram piece models.

The pieces are a fixed public vocabulary. Each language has a probability for each piece; a word
is as likely as the sum over all ways to cut it into pieces, which a forward pass adds up, and a
text as likely as its words together. No piece reaches over white space, so the sum over all
segmentations of a text is the product of the sums of its words. Probabilities are fitted by
expectation maximisation over all segmentations.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import common, lattice
from gridlake.llm.units import UnitCache, kept

SPACE = "▁"  # stands for a space in pieces: a fixed value of the format
#: Documents of each language that the models are fitted on, the first by a hash of doc_id.
FIT_DOCUMENTS = 1000
ROUNDS = 3
SMOOTHING = 0.1
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def pieces(path: str) -> dict[str, int]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    return {sp.id_to_piece(i): k for k, i in enumerate(normal)}


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Model:
    """log-likelihood of words under each language. ``weight``: pieces (and unknown characters as
    the last row) x languages."""

    def __init__(self, names: dict[str, int], languages: list[str], weight: np.ndarray):
        self.lattice = lattice.Lattice(names, unknown=len(names))
        self.names, self.languages, self.weight = names, languages, weight
        self.cache = UnitCache(self._score, kind=np.float64, limit=300_000)

    def _score(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        own = [SPACE + w for w in words]
        out = np.zeros((len(words), len(self.languages)))
        for at in lattice.by_size(own):
            edges = self.lattice.edges([own[i] for i in at])
            out[at] = lattice.forward(edges, self.weight, self.lattice.longest)[1]
        return words, out.reshape(-1), np.full(len(words), len(self.languages)), np.zeros(len(words))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and its share of the likelihood of all. Ties go to the first by name."""
        words = [words_of(t) if LETTER.search(t) else [] for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        names, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        on = np.flatnonzero(sizes)
        if len(on) and self.languages:
            rows = self.cache.rows([x for w in words for x in w])
            logs = self.cache.flat(rows)[0].reshape(-1, len(self.languages))
            first = (np.cumsum(sizes) - sizes)[on]
            total = np.add.reduceat(logs, first, axis=0)
            best = total.argmax(axis=1)
            top = total[np.arange(len(on)), best]
            score[on] = 1 / np.exp(total - top[:, None]).sum(axis=1)
            for i, b in zip(on.tolist(), best.tolist()):
                names[i] = self.languages[b]
        return names, score


def fit(docs: DataFrame, vocabulary: str, training: Column, documents: int = FIT_DOCUMENTS, rounds: int = ROUNDS) -> Model:
    """Fit on at most ``documents`` rows of each language among those with ``training`` true and a
    language, chosen by hash, so the choice does not depend on how the table is laid out.

    Word counts and expectations are summed in Spark; a round sends one number for each piece and
    language to the driver."""
    names = pieces(vocabulary)
    rows = docs.where(training & F.col("lang").isNotNull()).select("doc_id", "text", "lang").withColumn("h", F.xxhash64("doc_id", "text"))
    # Hashes are spread evenly, so a share of their range gives about twice the rows wanted; only
    # those are ranked.
    totals = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return Model(names, [], np.zeros((len(names) + 1, 0)))
    share = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, min(1.0, 2 * documents / n))])
    near = rows.select("lang", "h").where((F.col("h") / 2.0**64 + 0.5) <= share[F.col("lang")])
    first = Window.partitionBy("lang").orderBy("h")
    chosen = near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= documents)
    upto = {r.lang: r.h for r in chosen.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    languages = sorted(upto)
    limit = F.create_map(*[F.lit(x) for pair in upto.items() for x in pair])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(words_of(text or ""))
        flat = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
        yield pa.RecordBatch.from_pylist(
            [{"lang": a, "word": b, "n": c} for a, b, c in flat],
            pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]),
        )

    sample = rows.where(F.col("h") <= limit[F.col("lang")]).select("lang", "text")
    words = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words, path = common.written(words, "words")
    weight = np.full((len(names) + 1, len(languages)), 1.0 / (len(names) + 1))

    for _ in range(rounds):
        given = weight

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cut = lattice.Lattice(names, unknown=len(names))
            total = np.zeros_like(given)
            for batch in batches:
                of = np.array(batch.column("lang").to_pylist(), object)
                word, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
                for k, lang in enumerate(languages):
                    own = np.flatnonzero(of == lang)
                    units = [SPACE + word[i] for i in own]
                    for at in lattice.by_size(units):
                        edges = cut.edges([units[i] for i in at])
                        total[:, k] += lattice.expected(edges, given[:, k], n[own[at]])
            for k in range(len(languages)):
                on = np.flatnonzero(total[:, k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(on), k), pa.int32()), pa.array(on, pa.int32()), pa.array(total[on, k])],
                    ["lang", "piece", "n"],
                )

        got = words.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros_like(weight)
        counts[got["piece"].to_numpy(), got["lang"].to_numpy()] = got["n"].to_numpy()
        weight = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * len(counts))
    common.dropped(docs.sparkSession, path)
    return Model(names, languages, weight)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.

    ``und`` with score 0 where the text is NULL or has no letter, or no language was learnt. The
    score is the share of the predicted language in the likelihood. NULL ids and repeated rows
    keep their rows; other columns are ignored. No shuffle."""
    given, mark = (model.names, model.languages, model.weight), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(("languages", mark), lambda: Model(*given))
        for part, *_ in common.buffers(batches, "text"):
            lang, score = own.predict([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
