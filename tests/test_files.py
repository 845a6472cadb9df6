import os
import sqlite3
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from limnos.plans.canonical import query_canonical
from limnos.schema import READINGS
from limnos.sinks import mirror, pages
from limnos.sinks import snapshots as sink
from limnos.sources import mdb, sections, snapshots, sqlite, stations
from limnos.sources.files import children, delete, replace
from limnos.streaming import current

ROW = ("a", 5.0, datetime(2026, 5, 1), 1.0, None, None, None, None, None, None, datetime(2026, 5, 14))


@pytest.fixture
def readings(spark):
    return spark.createDataFrame([ROW], READINGS)


def test_snapshots_are_written_in_place_and_read_as_one(spark, readings, tmp_path):
    root = f"{tmp_path}/realtime"
    assert sink.write_snapshot(readings, root, date(2026, 5, 14)).first()["n_rows"] == 1
    sink.write_snapshot(readings.union(readings), root, date(2026, 5, 14))
    readings.withColumn("harvested_at", F.lit(datetime(2026, 6, 1))).coalesce(1).write.parquet(f"{root}/2026/06/snapshot_2026-06-01.parquet")
    df = snapshots.scan_snapshots(spark, root)
    assert df.schema == READINGS and df.count() == 3 and query_canonical(df).count() == 1
    assert snapshots.list_files(spark, root, "*.parquet").count() >= 2


def test_bad_snapshots_are_errors(spark, readings, tmp_path):
    with pytest.raises(sink.SnapshotError, match="no rows"):
        sink.write_snapshot(readings.limit(0), f"{tmp_path}/r", date(2026, 5, 14))
    with pytest.raises(sink.SnapshotError, match="no column Date"):
        sink.write_snapshot(readings.drop("Date"), f"{tmp_path}/r", date(2026, 5, 14))
    sink.write_snapshot(readings, f"{tmp_path}/r", date(2026, 5, 14))
    with pytest.raises(sink.SnapshotError, match="2026-05-14 has no rows"):
        sink.write_snapshot(readings.limit(0), f"{tmp_path}/r", date(2026, 5, 14))
    assert spark.read.parquet(sink.snapshot_path(f"{tmp_path}/r", date(2026, 5, 14))).count() == 1
    assert snapshots.scan_snapshots(spark, f"{tmp_path}/r").count() == 1 and children(spark, f"{tmp_path}/r/_incoming") == []


def test_a_folder_comes_back_when_its_successor_cannot_take_its_place(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "x").write_text("kept")
    with pytest.raises(OSError, match="could not be moved"):
        replace(spark, f"{tmp_path}/none", f"{tmp_path}/old")
    assert (tmp_path / "old" / "x").read_text() == "kept"
    (tmp_path / "new").mkdir()
    replace(spark, f"{tmp_path}/new", f"{tmp_path}/old")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["old"] and not (tmp_path / "old" / "x").exists()


def test_exports(spark, readings, tmp_path):
    path = sink.export_stamped(readings, str(tmp_path), "raw")
    assert path.endswith("raw_20260501") and spark.read.parquet(path).count() == 1
    with pytest.raises(sink.SnapshotError):
        sink.stamped_path(readings.union(readings.withColumn("Date", F.lit(None).cast("timestamp"))), str(tmp_path), "raw")
    assert spark.read.parquet(sink.export(readings.union(readings), f"{tmp_path}/e", ["Value"], 1)).columns == ["Value"]
    made = []
    make = lambda: made.append(1) or readings
    for refresh in (False, False, True):
        assert sink.cached(spark, f"{tmp_path}/cache", make, refresh).count() == 1
    assert len(made) == 2
    sink.export_page(readings.select("Value"), f"{tmp_path}/csv")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/csv").first()[0] == "1.0"


def test_tables(spark, readings):
    sink.register(readings, "v_readings")
    assert "v_readings" in snapshots.tables(spark) and spark.table("v_readings").count() == 1
    sink.save_table(readings, "t_readings")
    assert snapshots.fields(spark, "t_readings") == READINGS.names
    with pytest.raises(Exception, match="already exists"):
        sink.save_table(readings, "t_readings", overwrite=False)


def test_sql_over_files(spark, readings, tmp_path):
    readings.write.parquet(f"{tmp_path}/t")
    assert snapshots.scan_sql(spark, f"{tmp_path}/t", "SELECT max(Value) AS m FROM {table} WHERE Parameter = :p", p=5).first()["m"] == 1.0


def test_historic_shapes(spark):
    old = spark.sql("SELECT 'a' AS STATION_NUMBER, '5' AS Parameter, TIMESTAMP_NTZ '2022-01-01 00:00:00' AS Date, 'bad' AS Value, true AS Qualifiers, 'E' AS Grade, 1 AS RangeNumber")
    df = snapshots.adapt_historic(old)
    assert [f.dataType for f in df.schema] == [f.dataType for f in READINGS]
    row = df.first()
    assert (row["Parameter"], row["Date"], row["Value"], row["Qualifier"], row["Grade"], row["harvested_at"]) == (5.0, datetime(2022, 1, 1), None, "true", None, None)


def test_optional_sources(spark, tmp_path, caplog):
    assert snapshots.station_list(spark, f"{tmp_path}/none.csv").count() == 0 and "does not exist" in caplog.text
    (tmp_path / "ids.csv").write_text("stationid\na\na\nb\n")
    assert snapshots.station_list(spark, f"{tmp_path}/ids.csv").count() == 2


SECTIONS = "ID,Param,TS\n08XX001,{p},QR\n\n\n\n\nTime,Value,Approval\n2022-01-01T00:00:00Z,1.5,Final\nbad,x,\n"


def test_csv_of_two_sections(spark, tmp_path):
    for p in (5, 46):
        (tmp_path / f"f{p}.csv").write_text(SECTIONS.format(p=p))
    got = sections.scan_sections(spark, str(tmp_path)).orderBy("Parameter", F.desc("Value")).collect()
    assert len(got) == 4 and set(got[0].asDict()) == {"STATION_NUMBER", "Parameter", "Code", "Date", "Value", "Approval", "Name_En"}
    by = {(r.Parameter, r.Value): r for r in got}
    assert by["5", "1.5"].Name_En == "Water temperature" and by["5", "1.5"].Date == datetime(2022, 1, 1)
    assert by["46", "x"].Name_En is None and by["46", "x"].Date is None and by["46", "x"].Code == "QR"
    (tmp_path / "g.csv").write_text("ID,Param,TS\n08XX002,5,QR\n\n\n\n\nTime,Grade,Value\n2022-01-02T00:00:00Z,E,2.5\n")
    more = sections.scan_sections(spark, str(tmp_path))
    assert more.columns[3:] == ["Date", "Value", "Approval", "Grade", "Name_En"]
    assert [tuple(r) for r in more.filter("STATION_NUMBER = '08XX002'").select("Value", "Approval", "Grade").collect()] == [("2.5", None, "E")]
    assert more.filter("Grade IS NULL").count() == 4


def test_files_of_different_columns_are_one_table(spark, tmp_path):
    spark.sql("SELECT 1 AS id, 'a' AS a").write.parquet(f"{tmp_path}/x")
    spark.sql("SELECT 2 AS id, 'b' AS b").write.parquet(f"{tmp_path}/y")
    df = snapshots.scan_files(spark, f"{tmp_path}/x", f"{tmp_path}/y")
    assert {tuple(r) for r in df.select("id", "a", "b").collect()} == {(1, "a", None), (2, None, "b")}
    spark.sql("SELECT 'x' AS id").write.parquet(f"{tmp_path}/z")
    with pytest.raises(Exception, match="(?i)merge"):
        snapshots.scan_files(spark, f"{tmp_path}/x", f"{tmp_path}/z")


def test_a_station_that_fails_costs_itself_only(spark):
    def transport(station, days):
        if station == "bad":
            raise OSError("down")
        return None if station == "none" else [{"STATION_NUMBER": station, "Parameter": 5.0, "Date": datetime(2026, 5, 1), "Value": float(days)}]

    now = datetime(2026, 5, 14)
    got, failed = stations.pull(spark, transport, ["a", "bad", "none", "b"], now, chunk=2)
    assert sorted((r.STATION_NUMBER, r.Value, r.harvested_at) for r in got.collect()) == [("a", 581.0, now), ("b", 581.0, now)]
    assert [tuple(r) for r in failed.collect()] == [("bad", "OSError: down")]
    got, _ = stations.pull(spark, transport, ["a", "b", "bad"], now, days=[3, 40, 5])
    assert sorted((r.STATION_NUMBER, r.Value) for r in got.collect()) == [("a", 3.0), ("b", 40.0)]


def test_sqlite(spark, tmp_path):
    path = f"{tmp_path}/x.db"
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE readings (station TEXT, n INTEGER, value REAL)")
    db.executemany("INSERT INTO readings VALUES (?, ?, ?)", [("a", i, i / 2 if i % 3 else None) for i in range(25)])
    db.commit()
    db.close()
    df = sqlite.scan_sqlite(spark, path, "readings", rows=10)
    assert df.dtypes == [("station", "string"), ("n", "bigint"), ("value", "double")]
    assert df.count() == 25 and df.filter("value is null").count() == 9 and df.rdd.getNumPartitions() == 3
    assert sqlite.sqlite_tables(path) == ["readings"]


def test_a_stream_keeps_the_current_table(spark, readings, tmp_path):
    root, table = f"{tmp_path}/in", f"{tmp_path}/current"
    for harvested, value in ((datetime(2026, 5, 14), 1.0), (datetime(2026, 6, 1), None)):
        readings.withColumn("Value", F.lit(value).cast("double")).withColumn("harvested_at", F.lit(harvested)).write.mode("append").parquet(root)
        current.keep_current(current.stream_snapshots(spark, root), table, f"{tmp_path}/ckpt").awaitTermination()
        assert [r.Value for r in current.current(spark, table).collect()] == [value]
    assert current.generations(spark, table) == [0, 1]
    with pytest.raises(Exception, match="another stream"):
        current.keep_current(current.stream_snapshots(spark, root), table, f"{tmp_path}/other").awaitTermination()
    delete(spark, f"{table}/generation=1")
    readings.write.mode("append").parquet(root)
    with pytest.raises(Exception, match="no generation 1"):
        current.keep_current(current.stream_snapshots(spark, root), table, f"{tmp_path}/ckpt").awaitTermination()


def test_old_generations_go(spark, readings, tmp_path):
    root, table = f"{tmp_path}/in", f"{tmp_path}/current"
    for day in range(1, 5):
        readings.withColumn("Date", F.lit(datetime(2026, 5, day))).write.mode("append").parquet(root)
        current.keep_current(current.stream_snapshots(spark, root), table, f"{tmp_path}/ckpt").awaitTermination()
    assert current.generations(spark, table) == [2, 3] and current.current(spark, table).count() == 4
    with pytest.raises(current.StreamError):
        current.current(spark, f"{tmp_path}/none")


def test_a_folder_is_mirrored(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    for path, text in ((a / "x.txt", "1"), (a / "deep" / "y.txt", "22"), (b / "x.txt", "other"), (b / "extra.txt", "0")):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    steps = {r["path"]: r["action"] for r in mirror.mirror(spark, str(a), str(b)).collect()}
    assert steps == {"x.txt": "copy", "deep/y.txt": "copy", "extra.txt": "delete"}
    assert (b / "x.txt").read_text() == "1" and (b / "deep" / "y.txt").read_text() == "22" and not (b / "extra.txt").exists()
    assert {r["action"] for r in mirror.plan(spark, str(a), str(b)).collect()} == {"keep"}
    with pytest.raises(FileNotFoundError):
        mirror.mirror(spark, str(tmp_path / "none"), str(b))


def test_pages(spark, tmp_path):
    df = spark.createDataFrame([(1, "a & <b>"), (2, None)], "n int, name string")
    text = Path(pages.html_page(df, f"{tmp_path}/p.html", 'Some "rows"', "a tip")).read_text()
    assert "<tr><td>1</td><td>a &amp; &lt;b&gt;</td></tr>" in text and "<tr><td>2</td><td></td></tr>" in text
    assert "<caption>Some &quot;rows&quot; <b>a tip</b></caption>" in text and "<th>name</th>" in text
    with pytest.raises(ValueError, match="more than 1 rows"):
        pages.html_page(df, f"{tmp_path}/q.html", most=1)


MDB = r"""#!/usr/bin/env python3
import sys
if sys.argv[0].endswith("tables"):
    print("Station List\nOther")
elif sys.argv[2] != "Station List":
    sys.exit("no such table")
else:
    print('STATION NO,Name\n08XX001,"a, b"\n08XX002,')
"""


def test_access_files(spark, tmp_path, monkeypatch):
    with pytest.raises(mdb.MdbError, match="not installed"):
        mdb.mdb_tables("x.mdb")
    for program in ("mdb-tables", "mdb-export"):
        (tmp_path / program).write_text(MDB)
        (tmp_path / program).chmod(0o755)
    monkeypatch.setenv("PATH", f"{tmp_path}:{os.environ['PATH']}")
    assert mdb.mdb_tables("x.mdb") == ["Station List", "Other"]
    assert list(mdb._lines("mdb-export", "x.mdb", "Station List"))[1] == '08XX001,"a, b"\n'
    reader = mdb.Mdb({"path": "x.mdb", "table": "Station List"})
    assert reader.schema() == "`STATION NO` string, `Name` string"
    assert list(reader.reader(None).read(None)) == [("08XX001", "a, b"), ("08XX002", None)]
    with pytest.raises(mdb.MdbError, match="no such table"):
        list(mdb.Mdb({"path": "x.mdb", "table": "None"}).reader(None).read(None))
