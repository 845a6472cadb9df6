"""Every operator on a table of odd rows, and on one without rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from limnos.llm import jaccard, language, licenses, likelihood, mixing, neighbours, pieces, quality, rules, secrets

tokenizers = pytest.importorskip("public_tokenizers")
MODEL = tokenizers.path("piece_bpe_32k.model")


def voted(df):
    labels = df.select("doc_id", (F.col("row") % 2).cast("int").alias("quality"))
    return quality.score(df, quality.learn(df, labels, F.lit(True)))


OPERATORS = {
    "language": lambda df: language.identify(df, language.learn(df)),
    "quality": voted,
    "licenses": licenses.find_licenses,
    "likelihood": lambda df: likelihood.likelihoods(df, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)), share=2),
    "jaccard": jaccard.jaccard_groups,
    "rules": rules.quality_rules,
    "secrets": secrets.find_secrets,
    "redact": secrets.redact,
    "pieces": lambda df: pieces.digests(df, MODEL),
    "ids": lambda df: pieces.encode(df, MODEL),
    "mixing": mixing.mix,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_its_result(name, odd):
    got = OPERATORS[name](odd).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(name, odd):
    assert OPERATORS[name](odd.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["language", "secrets", "licenses", "rules", "pieces", "jaccard"])
def test_repeated_rows_get_equal_results(name, odd):
    by_id = {}
    for r in OPERATORS[name](odd).collect():
        by_id.setdefault(r["doc_id"], set()).add(str(r))
    assert all(len(v) == 1 for k, v in by_id.items() if k is not None)


KEEPING = {
    "language": lambda df: corpus_pipeline.language_stage(df.sparkSession, df, ""),
    "jaccard": jaccard.one_of_each,
    "secrets": secrets.redact,
    "mixing": mixing.mixed,
}


@pytest.mark.parametrize("name", KEEPING)
def test_columns_of_any_name_keep_their_values(name, odd):
    out = KEEPING[name](odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    rest = [c for c in odd.columns if c not in ("text", "lang")]
    got, given = ({tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in rest]).collect()} for df in (out, odd))
    assert got and got <= given
    assert KEEPING[name](odd.limit(0)).collect() == []


def test_one_of_each_decides_by_id_and_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (None, a), (None, b), (5, a), (5, c), (None, None), (None, None), (6, ""), (6, ""), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in jaccard.one_of_each(df).collect()), key=str)
    assert got == sorted([(1, a), (None, b), (5, c), (None, None), (6, ""), (7, "")], key=str)


def test_the_pipeline_takes_odd_rows(spark, odd):
    docs = odd
    for _, work in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(work(spark, docs, ""))
    assert docs.count() > 0 and set(docs.columns) >= {"doc_id", "ids", "n_tokens"}
    docs = odd.limit(0)
    for _, work in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(work(spark, docs, ""))
    assert docs.count() == 0


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.5, 0.5], None, [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0], [-1.0, 2.0], []]
    rows = [(i * 10, v, 0) for i, v in enumerate(vectors)] + [(0, [1.0, 0.0], 0), (None, [3.0, 3.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = [tuple(r) for r in neighbours.nearest(df, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 10, 1.0), (0, 2, 20, 0.5), (0, 3, 90, -1.0), (20, 1, 0, 0.5), (20, 2, 10, 0.5), (20, 3, 90, 0.5)]
    assert neighbours.nearest(df.limit(0), lambda i: i % 20 == 0).collect() == []
    assert neighbours.nearest(df.filter("vec_id = 30"), lambda i: i % 20 == 0).collect() == []
