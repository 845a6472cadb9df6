"""From raw documents to token ids: each stage works on all that the one before kept.

Stages are written as Parquet and read again, so a lost executor costs a stage's tasks and no more.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnos.llm import jaccard, language, mixing, pieces, secrets
from limnos.llm.text import plain_names
from limnos.plans.staging import stage

#: Python workers live through all stages, and some wait while others run; with these settings of Arrow's pool and
#: of glibc, arrays of a megabyte or more go back to the system when they are freed, and so do free ends of the heap.
ALLOCATORS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}


def lean(work: Callable) -> Callable:
    """The stage, its Python workers started with ALLOCATORS where the session has no settings of its own."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in ALLOCATORS.items():
            spark.sparkContext.environment.setdefault(name, value)
        return work(spark, docs, sf_dir)

    return run


@lean
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; a document without a given one gets the language found."""
    named, at = plain_names(docs)
    rest = tuple(new for name, new in at.items() if name != "doc_id")
    dictionaries = language.learn(named, at["text"], at["lang"])
    out = language.identify(named, dictionaries, at["doc_id"], at["text"], keep=rest).filter(~F.col("rejected"))
    lang = F.coalesce(at["lang"], F.col("lang_pred").cast(docs.schema["lang"].dataType))
    return out.select(*[(lang if name == "lang" else F.col(new)).alias(name) for name, new in at.items()])


@lean
def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id; of repeated rows, one."""
    return jaccard.one_of_each(docs)


@lean
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their text replaced."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


@lean
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the text that they decode to."""
    import public_tokenizers

    out = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("lang", "source"))
    return out.withColumns({"n_tokens": F.size("ids").cast("long"), "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)}).drop("decoded")


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]

#: No stage but mixing can be put in SQL; tests hold the whole against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), "-".join(name.lower().split()))
    return docs
