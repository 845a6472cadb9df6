import os

import duckdb
import pytest
from brute import WORD, rules as brute_rules, taken, targets
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from limnos.llm import mixing, rules


def plain(rows):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize(("query", "sql"), [(rules.op7, rules.SQL7), (mixing.op10, mixing.SQL10)])
def test_queries_equal_their_sql(query, sql, spark, sf):
    db = duckdb.connect()
    for f in os.listdir(sf):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    want = db.execute(sql)
    got = query(spark, sf).select(*[d[0] for d in want.description])
    assert plain(got.collect()) == plain(want.fetchall())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=40), max_size=8))
def test_counts_equal_brute_force(docs, texts):
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rules.quality_rules(docs(texts)).collect()}
    assert got == {i: brute_rules(t) for i, t in enumerate(texts, 1)}


def test_long_repeats(docs):
    texts = ["a b c " * 5000, " ".join(map(str, range(20_000))) + " 5 6 7", "x " * 10_000, "same line\n" * 300]
    got = {r["doc_id"]: r["n_repeat_words"] for r in rules.quality_rules(docs(texts)).collect()}
    assert got == {i: brute_rules(t)[4] for i, t in enumerate(texts, 1)}


def test_a_bad_host_takes_its_documents_along(spark):
    clean, bad = " ".join(f"proper{i} words" for i in range(40)), "# " * 60 + " ".join(f"w{i}" for i in range(60))
    rows = [(i, clean, "good") for i in range(40)] + [(100 + i, bad, "bad") for i in range(38)] + [(200, clean, "bad"), (201, clean, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_rules(df).collect()}
    assert all(kept[i] for i in range(40)) and kept[201] and not kept[200] and not kept[100]
    verdicts = rules.host_verdicts(rules.counts(df).withColumns({f"fail_{r}": c.cast("long") for r, c in rules.failures().items()}))
    rate = {r["__host"]: r["rate_symbols"] for r in verdicts.collect()}
    assert rate["good"] < 0.1 < 0.8 < rate["bad"] < 38 / 39


def test_a_rule_holds_where_a_host_breaks_it_more_than_others(spark):
    clean, symbols = " ".join(f"proper{i} words" for i in range(40)), "# " * 20 + " ".join(f"word{i}" for i in range(80))
    rows = [(1000 * h + i, symbols if i < bad else clean, f"host{h}") for h, bad in enumerate((1, 2, 30, 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gone = {r["doc_id"] for r in rules.quality_rules(df).filter("NOT kept AND NOT base_failed").collect()}
    assert gone == {2000 + i for i in range(30)}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["a", "b", "é", "z", "😀"]), st.integers(0, 5000), max_size=5), st.one_of(st.none(), st.integers(0, 900)))
def test_targets_are_those_of_resharing(spark, sizes, nameless):
    rows = [(k, False, v) for k, v in sizes.items()] + ([("", True, nameless)] if nameless is not None else [])
    got = {r["src"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "src string, src_null boolean, source_size long")).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    for (name, _, _), want in zip(order, targets([r[2] for r in order]) if sum(r[2] for r in order) else [0] * len(order), strict=True):
        assert got[name] == pytest.approx(want)


def test_documents_equal_brute_force(docs):
    texts = [" ".join(["word"] * (i * 37 % 90)) + "!" * (i % 4) for i in range(300)]
    df = docs(texts).withColumn("source", F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") < 200, F.lit("big")).otherwise(F.col("source")))
    want = taken([(r["doc_id"], r["text"], r["source"]) for r in df.collect()])
    got = {r["doc_id"]: r for r in mixing.mix(df.repartition(5)).collect()}
    assert {k: (r["size"], r["source_size"], r["taken"]) for k, r in got.items()} == {k: (v[0], v[1], v[3]) for k, v in want.items()}
    assert all(r["taken"] <= 3 * r["size"] for r in got.values())
    by = {}
    for r in df.collect():
        by.setdefault(r["source"], []).append(got[r["doc_id"]])
    assert all(abs(v[0]["target"] - sum(r["taken"] for r in v)) < 1 for v in by.values())
    copies = {r["doc_id"]: r["count"] for r in mixing.mixed(df).groupBy("doc_id").count().collect()}
    assert copies == {k: r["copies"] for k, r in got.items() if r["copies"]}
    assert all(len(WORD.findall(t)) == got[i]["size"] for i, t in enumerate(texts, 1))


def test_quality_weights_favour_documents(docs):
    plainly, oddly = " ".join(["words"] * 100), "x" * 3000
    df = docs([plainly] * 100 + [oddly] * 100)
    k = mixing._keyed(mixing._sourced(df, "doc_id", "text", "source")[0]).groupBy(F.col("id") <= 100).agg(F.avg("k")).collect()
    means = {r[0]: r[1] for r in k}
    assert means[True] < means[False] / 10


def test_repeated_rows_are_taken_as_often_by_both(spark):
    rows = [(7, " ".join(["word"] * 100), "a", "x")] * 10_000 + [(8, "other " * 50, "a", "y"), (None, "no id " * 9, "a", "z"), (None, "nor here " * 9, None, None)]
    df = spark.createDataFrame(rows + [(9, " ".join(["few"] * 10), "b", "x")] * 3, "doc_id long, text string, source string, lang string").repartition(6)
    by = ["doc_id", "lang"]
    want = {tuple(r[:2]): r[2] for r in mixing.mix(df.withColumn("source", F.col("source"))).join(df.select(*by).distinct(), "doc_id").groupBy(*by).agg(F.sum("copies")).collect()}
    got = {tuple(r[:2]): r[2] for r in mixing.mixed(df).groupBy(*by).count().collect()}
    assert {k: v for k, v in got.items() if k[0]} == {k: v for k, v in want.items() if k[0] and v}
    taken = mixing.mix(df).agg(F.sum("taken"), F.first("target")).first()
    assert abs(taken[0] - df.select(F.sum(mixing.n_words(F.col("text")))).first()[0]) < 3
    assert mixing.mix(df).count() == df.count()


def test_buckets_are_even_for_any_weight(spark):
    keys = spark.range(40_000).select((-F.log(mixing.uniform(F.col("id"), F.lit(""))) / F.when(F.col("id") % 2 == 0, 0.01).otherwise(0.37)).alias("k"))
    assert keys.groupBy(F.floor(F.log2("k") * mixing.BUCKETS)).count().agg(F.max("count")).first()[0] < 60
