import hashlib
import os

import pyarrow as pa
import pytest
from brute import base_secrets, redacted, taken
from test_jaccard import brute as components

import __spark_entry__
import corpus_pipeline
from limnos.llm import language

sentencepiece = pytest.importorskip("sentencepiece")
MODEL = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_rows_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    models = language.compressors(tuple(sorted(language.learn(docs).items())))
    rows = {r["doc_id"]: r for r in docs.collect() if not language.classify(r["text"], models)[2]}
    groups, _ = components([(i, r["text"]) for i, r in rows.items()])
    rows = {i: r for i, r in rows.items() if groups[i][1] == i}
    texts = {i: redacted(r["text"], base_secrets(r["text"])) for i, r in rows.items()}
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for i, (size, total, target, words) in taken([(i, texts[i], r["source"]) for i, r in rows.items()]).items():
        whole = int(target // total) if total else 0
        copies = whole + (size > 0 and words > whole * size and 2 * (words - whole * size) >= size)
        want += [(i, rows[i]["lang"], rows[i]["source"], lib.encode(texts[i]))] * copies
    got = [(r["doc_id"], r["lang"], r["source"], r["ids"]) for r in corpus_pipeline.run(spark, sf).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns(spark, sf):
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    for _, work in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(work(spark, docs, sf))
        assert docs.dtypes == first.dtypes and docs.count() > 0


def test_the_last_stage_decodes(spark, docs):
    texts = ["Some  text, to go there and back.", "", None, "ünïcödé 😀"]
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.encoding_stage(spark, docs(texts), "").collect()}
    assert got == {i: hashlib.sha256(lib.decode(lib.encode(t or "")).encode()).hexdigest() for i, t in enumerate(texts, 1)}


@pytest.mark.parametrize("own", [{}, {"MALLOC_TRIM_THRESHOLD_": "2097152"}])
def test_workers_of_all_stages_give_memory_back(spark, docs, monkeypatch, own):
    def settings(batches):
        list(batches)
        names = ("MALLOC_MMAP_THRESHOLD_", "MALLOC_TRIM_THRESHOLD_")
        yield pa.RecordBatch.from_pydict({"x": [pa.default_memory_pool().backend_name, *[os.environ.get(n, "") for n in names]]})

    for name, work in corpus_pipeline.STAGES:
        if name.startswith("mixing"):
            continue  # without Python workers
        monkeypatch.setattr(spark.sparkContext, "environment", {k: v for k, v in spark.sparkContext.environment.items() if k not in corpus_pipeline.ALLOCATORS} | own)
        rows = work(spark, docs(["some words of a text", None]).coalesce(1), "").coalesce(1)
        got = [r["x"] for r in rows.select("doc_id").mapInArrow(settings, "x string").collect()]
        assert got == ["system", "1048576", own.get("MALLOC_TRIM_THRESHOLD_", "1048576")]


def test_it_is_registered():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries if q.startswith("op")} and "pipeline" in queries
    assert set(sql) <= set(queries)
