"""The corpus queries: each numbered operator bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as vocabulary

from gridlake.llm import (
    chunk_dedup,
    conversation_repair,
    decontaminate,
    huffman_ids,
    jaccard_join,
    langid,
    line_runs,
    merkle,
    multi_index,
    pii,
    sentencepiece_codec,
    suffix_dedup,
    toxicity,
    twins,
)
from gridlake.llm.common import table
from gridlake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op4_chunk_dedup")
def chunk_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.dedup_chunks(table(spark, sf_dir, "documents"))


@query("op7_token_files")
def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    huffman_ids.write_ids(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return huffman_ids.crc_table(huffman_ids.read_ids(spark, path))


@query("op8_sentencepiece")
def sentencepiece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_decode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op2_suffix_dedup")
def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query("op1_langid")
def langid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.fit(docs, vocabulary("piece_bpe_32k.model"), F.coalesce(~held_out, F.lit(False)))
    found = langid.identify(docs, model)
    # A row without an id has no remainder: it is neither learnt from nor held out.
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op3_pii")
def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query("op5_multi_index")
def multi_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_SHINGLES = """[array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]"""
_WORDS = "list_filter(string_split_regex(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '')"


@query(
    "op6_decontaminate",
    f"""WITH d AS (SELECT doc_id, {_SHINGLES} AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents) WHERE len(w) > 4),
          i AS (SELECT item_id, {_SHINGLES} AS s FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 4),
          de AS (SELECT doc_id, unnest(s) AS h, generate_subscripts(s, 1) AS pos FROM d),
          ie AS (SELECT item_id, unnest(s) AS h, generate_subscripts(s, 1) AS pos FROM i),
          hits AS (SELECT DISTINCT doc_id, item_id, de.pos - ie.pos AS shift FROM de JOIN ie ON de.h = ie.h),
          windows AS (
            SELECT DISTINCT doc_id, item_id, least(len(i.s), len(d.s)) AS n, len(i.s) AS m,
                   greatest(0, least(shift + step, len(d.s) - least(len(i.s), len(d.s)))) AS start
            FROM hits JOIN d USING (doc_id) JOIN i USING (item_id), (SELECT unnest([-2, -1, 0, 1, 2]) AS step)),
          own AS (
            SELECT doc_id, item_id, start, h, count(*) AS c
            FROM windows JOIN de USING (doc_id) WHERE pos > start AND pos <= start + n GROUP BY ALL),
          kept AS (SELECT item_id, h, count(*) AS c FROM ie GROUP BY ALL),
          shared AS (
            SELECT doc_id, item_id, start, sum(least(own.c, kept.c)) AS v FROM own JOIN kept USING (item_id, h) GROUP BY ALL),
          scored AS (
            SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(n + 4 AS INTEGER) AS n_words,
                   CAST(v AS DOUBLE) / CAST(n + m - v AS DOUBLE) AS similarity
            FROM shared JOIN windows USING (doc_id, item_id, start))
        SELECT doc_id, item_id, similarity, start, n_words FROM scored WHERE similarity >= 0.8
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1""",
)
def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("distance")


@query("op9_jaccard_join")
def jaccard_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def fit_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Network | None:
    trained = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), trained)


@query("op10_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, fit_toxicity(spark, docs, sf_dir))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


@query("op11_conversation_repair", twins.CONVERSATION_REPAIR)
def conversation_repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


@query("op12_line_runs", twins.LINE_RUNS)
def line_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(table(spark, sf_dir, "documents"))


@query("op13_merkle", twins.merkle())
def merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(table(spark, sf_dir, "documents"))
