"""The pipeline as a whole, on documents whose fate is known."""

import gc
import random
import weakref

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from gridlake.llm import queries, sentencepiece_codec, toxicity, units


def test_every_query_is_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "sentencepiece"]


def tables(spark, folder, seed=1):
    draw = random.Random(seed)
    words = ["".join(draw.choice(["ba", "lo", "mi", "ter", "son", "ka"]) for _ in range(draw.randint(1, 4))) for _ in range(600)]
    prose = lambda n: [draw.choice(words) for _ in range(n)]
    items = [(i, " ".join(prose(30))) for i in range(5)]
    docs, labels, fate = [], [], {}
    for i in range(300):
        own, fate[i] = prose(80), "kept"
        if i % 6 == 0:
            for _ in range(4):
                own.insert(draw.randrange(len(own)), "venomous")
            fate[i] = "toxic"
        elif i % 20 == 7:
            own[40:40] = items[i % 5][1].split()
            fate[i] = "benchmark"
        elif i % 10 == 3:
            own[10:10] = ["joe.doe@mail.example.com"]
        labels.append((i, 1, int(fate[i] == "toxic")))
        docs.append((i, " ".join(own)))
    for i in range(1, 60, 6):  # one word of a copy differs
        copy = docs[i][1].split()
        copy[0] = "changed"
        docs.append((1000 + i, " ".join(copy)))
        fate[1000 + i] = "near" if fate[i] == "kept" else "near of " + fate[i]
    docs += [(2000, None), (2001, "")]
    fate |= {2000: "kept", 2001: "kept"}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(docs), fate


def test_documents_meet_their_fate(spark, tmp_path):
    docs, fate = tables(spark, str(tmp_path))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, f in fate.items() if f == "kept"}
    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    for i, r in got.items():
        text = (docs[i] or "").replace("joe.doe@mail.example.com", "[email]")
        assert list(r.ids) == sp.encode(text) and r.n_tokens == len(r.ids)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    tables(spark, str(tmp_path), seed=2)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).dtypes == docs.dtypes


@pytest.mark.parametrize("before, after", [(10_000, 1000), (0, 1000), (50, 50)])
@pytest.mark.parametrize("stage", ["toxicity", "pii", "sentencepiece"])
def test_what_a_stage_returns_goes_to_python_in_few_rows(spark, tmp_path, stage, before, after):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(20)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    try:
        spark.conf.set(name, before)
        dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
        assert int(spark.conf.get(name)) == after  # the frame is not run yet
    finally:
        spark.conf.set(name, was)


def test_columns_of_any_name_pass(spark, tmp_path):
    """Columns called like those that the stages make for themselves."""
    tables(spark, str(tmp_path), seed=5)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(60)
    for name in ("_key", "_th", "_hit", "_hit_th", "_toxicity", "_toxicity_", "score", "k", "a", "b", "spans", "n", "y", "words", "kind"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.where("_key <> 'own _key' or _th <> 'own _th' or _toxicity <> 'own _toxicity' or y <> 'own y'").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_rows_that_share_an_id_with_a_contaminated_one_stay(spark, tmp_path):
    tables(spark, str(tmp_path), seed=4)
    item = spark.read.parquet(f"{tmp_path}/benchmark.parquet").first().text
    clean = [(None, "a clean text without an id"), (None, None), (7, "another clean text of the same id"), (8, "clean")]
    rows = [*clean, (None, "before " + item), (7, item + " behind"), (9, item)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path))
    assert {(r.doc_id, r.text) for r in got.collect()} == set(clean) and got.count() == len(clean)


def test_an_empty_table_passes_all_stages(spark, tmp_path):
    tables(spark, str(tmp_path), seed=3)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


@pytest.fixture
def no_collection():
    """Python collects what refers to itself only when told to, as if it came to it too late."""
    units.forget()
    gc.disable()
    yield
    gc.enable()
    units.forget()


def test_a_tokenizer_is_gone_before_the_next_is_built(no_collection):
    codec = weakref.ref(units.kept("codec", lambda: sentencepiece_codec.Codec(path("piece_bpe_32k.model"))))
    assert codec() is not None
    assert units.kept("next", lambda: codec() is None)


@pytest.mark.parametrize("task", ["parts", "first", "later", "worst"])
def test_fitting_starts_without_the_tokenizer_of_a_run_before(no_collection, task):
    net = toxicity.Network(["bad"], ["^ba"])
    run = {
        "parts": toxicity._parts_counted, "first": toxicity._picker(net, np.zeros(2), 1, 0),
        "later": toxicity._picker(net, None, 1, 1), "worst": toxicity._worst_of(net),
    }[task]
    codec = weakref.ref(units.kept("codec", lambda: sentencepiece_codec.Codec(path("piece_bpe_32k.model"))))
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "y": [0, 1], "text": ["good or bad", None]})
    assert sum(b.num_rows for b in run(iter([rows]))) and codec() is None
