from datetime import datetime

import pytest
from pyspark.sql import functions as F

from limnos.functions import scalars
from limnos.operators import latest, sets, tidy
from limnos.operators.amalgamate import amalgamate, counts_agree, overlap_counts
from limnos.operators.places import zone_of

KEYS = ["k", "v"]


@pytest.fixture
def pair(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, 2.0, "x")], "k int, v double, p string")
    b = spark.createDataFrame([(1, None, "y"), (2, 3.0, "y"), (4, None, None)], "k int, v double, q string")
    return a, b


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merging_takes_new_rows_and_keeps_the_others(pair):
    a, b = pair
    got = rows(amalgamate(a, b, KEYS))
    assert got == rows(a.sparkSession.createDataFrame([(1, None, "x", None), (2, 2.0, "x", None), (2, 3.0, None, "y"), (4, None, None, None)], "k int, v double, p string, q string"))
    n = overlap_counts(a, b, KEYS).first()
    assert n["n_both"] == n["n_identity"] == 1
    assert counts_agree(a, b, amalgamate(a, b, KEYS), KEYS)
    twice = a.union(a)
    assert not counts_agree(twice, b, amalgamate(a, b, KEYS), KEYS)


def test_joins_match_nulls(pair):
    a, b = pair
    assert rows(sets.natural_left_join(a, b)) == [(1, None, "x", "y"), (2, 2.0, "x", None)]
    with pytest.raises(sets.SchemaError):
        sets.natural_left_join(a.select("p"), b.select("q"))


def test_rows_as_sets(pair):
    a, b = (x.select(*KEYS) for x in pair)
    assert rows(sets.rows_intersect(a, b)) == [(1, None)]
    assert rows(sets.rows_difference(a, b)) == [(2, 2.0)]
    assert sets.rows_union(a, b).count() == 4 == a.distinct().count() + b.distinct().count() - sets.rows_intersect(a, b).count()


def test_binding_checks_types(pair):
    a, b = pair
    assert sets.bind_rows(a, b).columns == ["k", "v", "p", "q"]
    with pytest.raises(sets.SchemaError, match="k is int"):
        sets.bind_rows(a, b.withColumn("k", F.col("k").cast("string")))


def test_first_and_repeated(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (None, 3), (None, 4), (5, 5)], "k int, o int")
    assert rows(latest.keep_first(df, ["k"], ["o"])) == [(1, 1), (5, 5), (None, 3)]
    assert latest.repeated(df, ["k"]).count() == 4


def test_membership(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "s string") for xs in (["a", "b", None], ["b", None]))
    assert rows(sets.members(a, "s", b, "s")) == [("b",)]
    assert rows(sets.missing(a, "s", b, "s")) == [("a",)]


def test_strict_aggregates(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert df.agg(tidy.strict_max("x"), F.max("x")).first() == (None, 1.0)
    assert df.filter("x > 5").agg(tidy.strict_max("x")).first()[0] is None
    lo, hi = tidy.strict_range("x")
    assert df.filter("x is not null").agg(lo, hi).first() == (1.0, 1.0)


def test_types(spark):
    like = spark.createDataFrame([(1.0, "a")], "v double, s string")
    df = spark.createDataFrame([("2.5", 1, None), ("E", 2, None)], "v string, s int, n string")
    got = tidy.conform_types(like, df)
    assert got.dtypes == [("v", "double"), ("s", "string"), ("n", "string")] and rows(got.select("v")) == [(2.5,), (None,)]
    assert rows(tidy.type_conflicts({"a": like, "b": df})) == [("s", "a", "string"), ("s", "b", "int"), ("v", "a", "double"), ("v", "b", "string")]
    assert tidy.drop_null_columns(df).columns == ["v", "s"]
    assert tidy.clean_names(df.toDF("A b", "C.d", "e")).columns == ["a_b", "c_d", "e"]
    assert tidy.columns_between(df, "v", "s") == ["v", "s"] and tidy.without(df, "^s").columns == ["v", "n"]


def test_numbering_and_filling_over_partitions(spark):
    n = 500
    df = spark.range(n).withColumn("z", F.when(F.col("id") % 97 == 5, F.col("id"))).withColumn("tz", F.when(F.col("id") < 480, F.col("id") % 3)).repartition(7)
    got = tidy.numbered(df, ["tz", "id"]).orderBy("ordinal").collect()
    want = sorted(df.collect(), key=lambda r: (r.tz is None, r.tz, r.id))
    assert [r.ordinal for r in got] == list(range(1, n + 1)) and [r.id for r in got] == [r.id for r in want]
    filled = {r.id: r.z for r in tidy.fill_down(df, ["z"], ["tz", "id"]).collect()}
    last, expect = None, {}
    for r in want:
        last = r.z if r.z is not None else last
        expect[r.id] = last
    assert filled == expect


def test_paging(spark):
    assert [r.id for r in tidy.page(spark.range(25), [F.col("id").desc()], 10, 2).collect()] == [4, 3, 2, 1, 0]


def test_scalars(spark):
    df = spark.createDataFrame([("5", "2026-05-14 01:02:03", 1.0, 2.0), ("46", "no", None, 2.0)], "Parameter string, t string, lon double, lat double")
    got = df.select(scalars.parameter_name().alias("n"), scalars.instant(F.col("t")).alias("t"), scalars.wkb("lon", "lat").alias("g"), scalars.number("t").alias("x")).collect()
    assert got[0].n == "Water temperature" and got[1].n is None and got[1].t is None and got[0].t == datetime(2026, 5, 14, 1, 2, 3)
    assert bytes(got[0].g) == b"\x01\x01\x00\x00\x00" + b"\x00" * 6 + b"\xf0?" + b"\x00" * 7 + b"@" and got[1].g is None
    when = F.lit(datetime(2026, 5, 14))
    row = df.select(scalars.stamped("raw", when), scalars.snapshot_name(when), scalars.grouped(F.lit(1234567)), scalars.days_between(F.to_date(F.lit("2026-05-01")), F.to_date(when)), scalars.chunk_of(F.lit(51))).first()
    assert tuple(row) == ("raw_20260514", "2026/05/snapshot_2026-05-14", "1,234,567", 13, 2)


def test_zones_of_points(spark):
    rings = {"a": [(0, 0), (4, 0), (4, 4), (0, 4)], "b": [(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)], "bent": [(-9, -9), (-1, -9), (-9, -1)]}
    zones = spark.createDataFrame([(k, [(float(x), float(y)) for x, y in v]) for k, v in rings.items()], "zone string, ring array<struct<lon:double,lat:double>>")
    want = {(1, 1): "a", (3, 3): "a", (5, 5): "b", (5, 1): None, (-8, -8): "bent", (-2, -2): None, (-2, -8.5): "bent", (100, 50): None, (None, 1): None}
    points = spark.createDataFrame([(None if x is None else float(x), float(y)) for x, y in want], "lon double, lat double")
    got = [(r["lon"], r["lat"], r["zone"]) for r in zone_of(points, zones).collect()]
    assert sorted(got, key=str) == sorted([(None if x is None else float(x), float(y), z) for (x, y), z in want.items()], key=str)
