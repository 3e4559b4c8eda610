"""The corpus pipeline: documents in, token ids of clean, distinct documents out.

Each stage gets what the one before it kept and calls one operator of ``gridlake.llm``. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import common, decontaminate, jaccard_join, pii, queries, sentencepiece_codec, toxicity

#: Word shingles of the near-duplicate stage, and the similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Texts that go to Python and back at once, in all stages that hand any there. An executor and its workers hold
#: several batches meanwhile. The setting stays: what a stage returns runs later, when it is written.
ROWS = 1000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the threshold stay; the network learns from the labelled among ``docs``. NULL
    and empty texts get the score of no words, repeated rows each the same one; texts of any length
    are read whole. Further columns, whatever their names, are passed on."""
    common.at_most(spark, ROWS)
    network = queries.fit_toxicity(spark, docs, sf_dir)
    name = common.spare("_toxicity", docs.columns)
    scored = toxicity.score(docs, network, keep=True, name=name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the smallest id stays. NULL texts
    and texts without a word link with nothing, so each of those stays; of repeated rows one does.
    Texts of any length are compared whole."""
    return jaccard_join.first_of_each(docs, SHINGLE, PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay. Rows that share an id, or have none, are told
    apart by the hash of their text."""
    found = decontaminate.contaminated(docs, common.table(spark, sf_dir, "benchmark"), texts=True)
    hit, text = common.spare("_hit", docs.columns), common.spare("_hit_th", docs.columns)
    found = found.select(F.col("doc_id").alias(hit), F.col("th").alias(text)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(hit)) & (F.xxhash64("text") == F.col(text))
    return docs.join(found, same, "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets; n_chars follows the text."""
    common.at_most(spark, ROWS)
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of their decoding. A NULL text has the ids
    of an empty one: none. Repeated rows are encoded each; texts of any length whole."""
    common.at_most(spark, ROWS)
    return sentencepiece_codec.encode_decode(docs, vocabulary("piece_bpe_32k.model"), keep=("ids",))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", mask_personal_data),
    ("sentencepiece", encode),
]

#: Neither the network, nor the fitted labelers, nor the tokenizer can be put in SQL; the tests
#: hold the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each but the last written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs, path = common.written(stage(spark, docs, sf_dir), name)
        if before is not None:
            common.dropped(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
