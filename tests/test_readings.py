from datetime import UTC, date, datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from limnos.functions.timebounds import to_utc
from limnos.plans.canonical import Readings, query_canonical
from limnos.schema import READINGS

MAY, JUNE = datetime(2026, 5, 14), datetime(2026, 6, 1)


def reading(station="08XX001", parameter=5.0, when=datetime(2026, 5, 1), value=1.0, harvested=MAY, unit=None):
    return (station, parameter, when, value, unit, None, None, None, None, None, harvested)


@pytest.fixture
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), READINGS)


def values(df):
    return sorted((r["Value"] for r in df.collect()), key=lambda v: (v is None, v))


def test_a_correction_wins(frame):
    assert values(query_canonical(frame(reading(value=1.0), reading(value=2.0, harvested=JUNE)))) == [2.0]


def test_a_retraction_wins_as_a_whole_row(frame):
    assert values(query_canonical(frame(reading(value=1.0), reading(value=None, harvested=JUNE)))) == [None]


def test_ties_keep_one_row_and_always_the_same(frame):
    rows = [reading(value=1.0, unit="a"), reading(value=1.0, unit="b"), reading(value=3.0)]
    kept = [query_canonical(frame(*order).repartition(3)).collect() for order in (rows, rows[::-1])]
    assert [len(k) for k in kept] == [1, 1] and kept[0] == kept[1]


def test_rows_of_old_snapshots_stay(frame):
    assert values(query_canonical(frame(reading(value=1.0), reading(value=2.0, harvested=JUNE, when=datetime(2026, 5, 2))))) == [1.0, 2.0]


def test_an_unstamped_row_loses(frame):
    assert values(query_canonical(frame(reading(value=1.0, harvested=None), reading(value=2.0)))) == [2.0]


def test_an_end_that_is_a_day_includes_it(frame):
    days = frame(*[reading(when=w, value=float(i)) for i, w in enumerate([datetime(2026, 5, 1), datetime(2026, 5, 1, 23, 59, 59), datetime(2026, 5, 2)])])
    assert values(query_canonical(days, end=date(2026, 5, 1))) == [0.0, 1.0]
    assert values(query_canonical(days, end=datetime(2026, 5, 1))) == [0.0]
    assert values(query_canonical(days, end="2026-05-01")) == [0.0]
    assert values(query_canonical(days, start=date(2026, 5, 2))) == [2.0]


def test_bounds_are_utc():
    pacific = timezone(timedelta(hours=-8))
    assert to_utc(datetime(2026, 5, 1, 16, tzinfo=pacific)) == to_utc(date(2026, 5, 2)) == datetime(2026, 5, 2, tzinfo=UTC)


def test_bounds_of_naive_columns(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-05-01 23:59:59' AS Date, 's' AS STATION_NUMBER, 5D AS Parameter, 1D AS Value, TIMESTAMP '2026-05-14' AS harvested_at")
    assert query_canonical(df, end=date(2026, 5, 1)).count() == 1
    assert query_canonical(df, start=date(2026, 5, 2)).count() == 0


def test_no_list_is_all_and_an_empty_one_is_none(frame):
    df = frame(reading("a"), reading("b"))
    assert [query_canonical(df, stations=s).count() for s in (None, [], ["a"])] == [2, 0, 1]


def test_value_filters_stay_above(frame):
    df = frame(reading(value=9.0), reading(value=1.0, harvested=JUNE))
    assert query_canonical(df).filter("Value > 5").count() == 0


def test_means_leave_out_nulls_and_count_them(frame):
    df = frame(*[reading(when=datetime(2026, 5, 1, h), value=v) for h, v in enumerate([1.0, None, 3.0])])
    row = Readings().daily_mean(df).first()
    assert (row["mean"], row["n_obs"], row["date_day"]) == (2.0, 3, date(2026, 5, 1))


def test_tables_of_stations(frame, spark):
    stations = spark.createDataFrame([("a",), (None,), ("z",)], "STATION_NUMBER string")
    got = {r["STATION_NUMBER"]: r["max_date"] for r in Readings().station_table(stations, frame(reading("a"), reading(None)), "STATION_NUMBER").collect()}
    assert got == {"a": datetime(2026, 5, 1), None: datetime(2026, 5, 1), "z": None}


def test_key_filters_reach_the_scan(frame, tmp_path):
    frame(reading()).write.parquet(f"{tmp_path}/t")
    df = frame().sparkSession.read.parquet(f"{tmp_path}/t")
    plan = query_canonical(df, [5.0], ["a"], date(2026, 5, 1), date(2026, 5, 2)).select("Value")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert all(x in pushed for x in ("STATION_NUMBER", "Parameter", "Date"))
    assert "WindowGroupLimit" in plan


rows = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 2), st.sampled_from([None, 1.0, 2.0]), st.sampled_from([None, MAY, JUNE])), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_properties(frame, data):
    df = frame(*[reading(s, 5.0, datetime(2026, 5, 1 + d), v, h) for s, d, v, h in data])
    once = query_canonical(df)
    got = sorted(map(str, once.collect()))
    assert sorted(map(str, query_canonical(once).collect())) == got
    assert once.select("STATION_NUMBER", "Parameter", "Date").distinct().count() == len(got)
    kept = once.filter("STATION_NUMBER = 'a'")
    assert sorted(map(str, kept.collect())) == sorted(map(str, query_canonical(df.filter(F.col("STATION_NUMBER") == "a")).collect()))
