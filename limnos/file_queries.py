"""Queries over files, tables and services: what one part of the engine wrote, another one reads back.

Files lie in the session's shared folder. `nation` and `supplier` stand in for stations, `events` for readings.
"""

from __future__ import annotations

import sqlite3
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.functions.scalars import grouped, instant, parameter_name, point, shifted, wkb
from limnos.functions.timebounds import literal
from limnos.operators import tidy
from limnos.operators.places import zone_of
from limnos.plans.canonical import query_canonical
from limnos.plans.staging import fresh_path
from limnos.sinks import mirror as mirrors
from limnos.sinks import pages
from limnos.sinks import snapshots as sink
from limnos.sources import snapshots as source
from limnos.sources.sections import ABOUT, BODY_LINE, scan_sections
from limnos.sources.sqlite import scan_sqlite, sqlite_tables
from limnos.sources.stations import pull

HARVESTED = datetime(2024, 2, 1)


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _naive(column: str):
    return F.from_utc_timestamp(column, F.current_timezone()).cast("timestamp_ntz").alias(column)


# ---- snapshots -------------------------------------------------------------------------------------------


def _readings(events: DataFrame, more: float, harvested: datetime) -> DataFrame:
    code = F.when(F.col("event_type") == "view", 5).when(F.col("event_type") == "click", 6).otherwise(46)
    rows = events.select(F.col("user_id").cast("string").alias("STATION_NUMBER"), code.alias("Parameter"), F.col("ts").alias("Date"), (F.col("value") + more).alias("Value"))
    return source.adapt_historic(rows).withColumn("harvested_at", F.lit(harvested.replace(tzinfo=UTC)))


def _tree(spark, sf_dir: str) -> str:
    """Two overlapping deliveries as a tree of snapshots, the second one with corrected values."""
    root, events = fresh_path(spark, "tree"), _table(spark, sf_dir, "events")
    first = events.filter(F.col("ts") < literal(datetime(2024, 1, 10), naive=True))
    later = events.filter(F.col("ts") >= literal(datetime(2024, 1, 5), naive=True))
    sink.write_snapshot(_readings(first, 0.0, HARVESTED), root, date(2024, 2, 1))
    sink.write_snapshot(_readings(later, 1.0, HARVESTED + timedelta(days=30)), root, date(2024, 3, 2))
    return root


def snapshot_tree(spark, sf_dir):
    df = source.scan_snapshots(spark, _tree(spark, sf_dir))
    return query_canonical(df, parameter=[5, 6]).select("STATION_NUMBER", "Parameter", _naive("Date"), "Value")


def snapshot_rerun(spark, sf_dir):
    """A day's snapshot written again takes the first one's place; an empty rerun leaves it."""
    root, events, day = fresh_path(spark, "rerun"), _table(spark, sf_dir, "events"), date(2024, 2, 1)
    for rows in (events, events.filter("event_type = 'view'")):
        sink.write_snapshot(_readings(rows, 0.0, HARVESTED), root, day)
    try:
        sink.write_snapshot(_readings(events.limit(0), 0.0, HARVESTED), root, day)
        refused = False
    except sink.SnapshotError:
        refused = True
    df = spark.read.parquet(sink.snapshot_path(root, day))
    return df.agg(F.count("*").alias("n"), F.max("Value").alias("top"), F.lit(refused).alias("refused"))


# ---- files -----------------------------------------------------------------------------------------------


def files_union(spark, sf_dir):
    orders, root = _table(spark, sf_dir, "orders"), fresh_path(spark, "files")
    paths = [
        sink.export(orders.filter("o_orderkey % 2 = 0"), f"{root}/even", ["o_orderkey", "o_custkey"]),
        sink.export(orders.filter("o_orderkey % 2 <> 0"), f"{root}/odd", ["o_orderkey", "o_totalprice"]),
    ]
    return source.scan_files(spark, *paths)


def file_single(spark, sf_dir):
    return source.scan_files(spark, f"{sf_dir}/region.parquet")


def sql_over_file(spark, sf_dir):
    text = "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM {table} WHERE o_totalprice > :least GROUP BY o_orderstatus"
    return source.scan_sql(spark, f"{sf_dir}/orders.parquet", text, least=100_000.0)


def sql_text_filter(spark, sf_dir):
    """A filter on a code kept as text."""
    path = sink.export(_table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size")), fresh_path(spark, "text"))
    return source.scan_sql(spark, path, "SELECT p_partkey FROM {table} WHERE p_size = :code", code="5")


def catalog_province(spark, sf_dir):
    return source.catalog(_table(spark, sf_dir, "customer"), "BUILDING", "c_mktsegment").select("c_custkey", "c_mktsegment")


def station_csv(spark, sf_dir):
    """A list of stations as a CSV file, of which ids come twice."""
    path, rows = fresh_path(spark, "ids"), _table(spark, sf_dir, "supplier").select("s_nationkey")
    rows.write.option("header", "true").csv(path)
    return source.station_list(spark, path, "s_nationkey").withColumnRenamed("s_nationkey", "station")


def source_optional(spark, sf_dir):
    """Two optional sources, of which one is not there."""
    nation = _table(spark, sf_dir, "nation")
    here, gone = (source.optional(spark, path, nation.schema) for path in (f"{sf_dir}/nation.parquet", fresh_path(spark, "none")))
    return here.withColumn("of", F.lit("here")).unionByName(gone.withColumn("of", F.lit("gone"))).groupBy("of").agg(F.count("*").alias("n"), F.max("n_name").alias("last"))


def _sections(spark, sf_dir: str) -> str:
    """A file of two sections for each region: its suppliers' nations under a header block. Some have a further column."""
    nation, root = _table(spark, sf_dir, "nation"), fresh_path(spark, "sections")
    about = F.concat_ws(",", F.concat(F.lit("ST"), "n_regionkey"), F.when(F.col("n_regionkey") % 2 == 0, "5").otherwise("46"), F.lit("QR"), F.lit("spare"))
    block = [F.lit(",".join([*ABOUT, "Other"])), about, *[F.lit("")] * (BODY_LINE - 2)]
    wide = F.col("n_regionkey") == 1
    head = F.when(wide, F.lit("Time,Value,Approval")).otherwise(F.lit("Time,Value"))
    when = F.concat(F.lit("2024-01-"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0"), F.when(F.col("n_nationkey") % 7 == 3, F.lit(" noon")).otherwise(F.lit("T06:30:00Z")))
    body = F.concat_ws(",", when, F.col("n_name"), F.when(wide, F.lit("Final")))
    # the rows of a file are few (25 nations): a line each, in order
    lines = nation.select("n_regionkey", F.lit(1).alias("part"), F.col("n_nationkey").alias("at"), body.alias("line"))
    for i, line in enumerate([*block, head]):
        lines = lines.unionByName(nation.select("n_regionkey", F.lit(0).alias("part"), F.lit(i).alias("at"), line.alias("line")).distinct())
    lines = lines.repartition("n_regionkey").sortWithinPartitions("n_regionkey", "part", "at")
    lines.select("n_regionkey", "line").write.partitionBy("n_regionkey").text(f"{root}/txt")
    out = f"{root}/csv"
    for row in source.list_files(spark, f"{root}/txt", "*.txt").collect():  # one of each region
        name = row["path"].split("n_regionkey=")[1].split("/")[0]
        mirrors.copy(spark, row["path"], f"{out}/f{name}.csv")
    return out


def csv_two_section(spark, sf_dir):
    df = scan_sections(spark, _sections(spark, sf_dir))
    return df.select(*ABOUT, "Name_En", F.date_format(F.to_utc_timestamp("Date", F.current_timezone()), "yyyy-MM-dd").alias("day"), "Value", "Approval")


def file_listing(spark, sf_dir):
    root = fresh_path(spark, "listing")
    _table(spark, sf_dir, "events").write.partitionBy("event_type").parquet(root)
    files = source.list_files(spark, root, "*.parquet")
    return files.groupBy(F.regexp_extract("path", "event_type=([^/]*)", 1).alias("event_type")).agg((F.min("length") > 0).alias("filled"))


def sqlite_scan(spark, sf_dir):
    path = fresh_path(spark, "db").removeprefix("file://").removeprefix("file:") + ".sqlite"
    rows = [tuple(r) for r in _table(spark, sf_dir, "nation").collect()]  # 25 rows
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE nation (key INTEGER, name TEXT, region INTEGER)")
    db.executemany("INSERT INTO nation VALUES (?, ?, ?)", rows)
    db.commit()
    db.close()
    (table,) = sqlite_tables(path)
    return scan_sqlite(spark, path, table, rows=10)


def table_fields(spark, sf_dir):
    name = "limnos_" + fresh_path(spark, "t").rsplit("-", 1)[1]
    for _ in range(2):
        sink.save_table(_table(spark, sf_dir, "nation"), name)
    try:
        n = spark.table(name).count()
        rows = [(i, f, name in source.tables(spark), n) for i, f in enumerate(source.fields(spark, name))]
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(rows, "place int, field string, listed boolean, n_rows long")


def cached_result(spark, sf_dir):
    path = fresh_path(spark, "cache")
    make = lambda: _table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("value").alias("top"))
    sink.cached(spark, path, make)
    return sink.cached(spark, path, lambda: 1 / 0)


def export_columns(spark, sf_dir):
    path, customer = fresh_path(spark, "export"), _table(spark, sf_dir, "customer")
    sink.export(customer, path)
    return spark.read.parquet(sink.export(customer, path, ["c_custkey", "c_acctbal"]))


def view_sql(spark, sf_dir):
    name = "limnos_" + fresh_path(spark, "v").rsplit("-", 1)[1]
    sink.register(_table(spark, sf_dir, "supplier"), name)
    out = spark.sql(f"SELECT s_nationkey, count(*) AS n FROM {name} GROUP BY s_nationkey")
    spark.catalog.dropTempView(name)
    return out


def mirror_plan(spark, sf_dir):
    """A tree that lacks files, has others and is then made like its model."""
    events, root = _table(spark, sf_dir, "events"), fresh_path(spark, "mirror")
    model, target = f"{root}/a", f"{root}/b"
    events.filter("event_type IN ('view', 'click')").write.partitionBy("event_type").parquet(model)
    events.filter("event_type IN ('error')").write.partitionBy("event_type").parquet(target)
    done = mirrors.mirror(spark, model, target)
    after = mirrors.plan(spark, model, target)
    kind = F.regexp_extract("path", "event_type=([^/]*)", 1).alias("event_type")
    return done.select("action", kind).unionByName(after.select("action", kind)).distinct()


# ---- columns ---------------------------------------------------------------------------------------------


def columns_range(spark, sf_dir):
    df = _table(spark, sf_dir, "customer")
    return df.select(tidy.columns_between(df, "c_custkey", "c_nationkey"))


def columns_first(spark, sf_dir):
    df = _table(spark, sf_dir, "supplier")
    return df.select(df.columns[:3])


def columns_clean(spark, sf_dir):
    return tidy.clean_names(_table(spark, sf_dir, "region").toDF("Region.Key (id)", "R-Name"))


def columns_without(spark, sf_dir):
    return tidy.without(_table(spark, sf_dir, "customer"), "key$")


def columns_drop(spark, sf_dir):
    places = _table(spark, sf_dir, "nation").withColumn("geometry", point(F.col("n_nationkey"), F.col("n_regionkey")))
    return places.drop("geometry", "n_regionkey")


def column_constant(spark, sf_dir):
    return _table(spark, sf_dir, "region").withColumn("source", F.lit("delivery")).withColumn("run", F.lit(7))


def column_pull(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select("c_nationkey").distinct()


def columns_null(spark, sf_dir):
    df = _table(spark, sf_dir, "nation").withColumns({"empty": F.lit(None).cast("string"), "some": F.nullif("n_regionkey", F.lit(1))})
    return tidy.drop_null_columns(df)


def types_conformed(spark, sf_dir):
    like = spark.createDataFrame([], "p_partkey long, p_size double, p_brand double")
    df = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size"), "p_brand", "p_name")
    return tidy.conform_types(like, df)


def type_report(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    other = nation.withColumn("n_nationkey", F.col("n_nationkey").cast("string"))
    return tidy.type_conflicts({"old": nation, "new": other, "region": _table(spark, sf_dir, "region")})


def null_filter(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").withColumn("v", F.nullif("n_regionkey", F.lit(2)))
    return rows.groupBy(F.col("v").isNull().alias("missing")).agg(F.count("*").alias("n"), F.count("v").alias("n_known"))


def historic_shape(spark, sf_dir):
    old = _table(spark, sf_dir, "events").select(F.concat(F.lit("0"), "user_id").alias("STATION_NUMBER"), F.lit("5").alias("Parameter"), F.col("ts").alias("Date"), F.substring("event_type", 1, 1).alias("Value"), F.col("event_type").alias("Qualifiers"))
    out = source.adapt_historic(old)
    return out.select("STATION_NUMBER", "Parameter", _naive("Date"), "Value", "Qualifier", "Grade")


# ---- values ----------------------------------------------------------------------------------------------


def instants(spark, sf_dir):
    text = F.concat(F.lit("2024-"), F.lpad((F.col("n_nationkey") % 14).cast("string"), 2, "0"), F.lit("-05 06:07:08"))
    return _table(spark, sf_dir, "nation").select("n_nationkey", F.date_format(instant(text), "yyyyMMddHHmmss").alias("t"))


def parameter_names(spark, sf_dir):
    codes = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("code"))
    return codes.withColumn("name_en", parameter_name("code"))


def grouped_numbers(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", grouped(F.col("p_partkey") * 12_345).alias("shown"))


def date_shift(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return _table(spark, sf_dir, "orders").select("o_orderkey", shifted(day, 1).alias("next"), shifted(day, -180).alias("half_year_before"), shifted(day, F.col("o_custkey").cast("int") % 5).alias("later"))


def points_wkb(spark, sf_dir):
    place = point(F.col("n_nationkey") % 3, F.when(F.col("n_nationkey") % 5 != 0, F.col("n_regionkey") % 2))
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", place.alias("p"))
    return rows.select("n_nationkey", F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat"), F.hex(wkb(F.col("p.lon"), F.col("p.lat"))).alias("geometry"))


ZONES = {"box": [(0, 0), (10, 0), (10, 8), (0, 8)], "wedge": [(0, 8), (10, 8), (5, 13), (0, 8)], "far": [(-40, 20), (-30, 20), (-30, 24)]}


def time_zones(spark, sf_dir):
    zones = spark.createDataFrame([(k, [(float(x), float(y)) for x, y in v]) for k, v in ZONES.items()], "zone string, ring array<struct<lon:double,lat:double>>")
    lon, lat = (F.col("c_custkey") % 71) * 0.37 - 10.013, (F.col("c_custkey") % 53) * 0.41 - 5.017
    points = _table(spark, sf_dir, "customer").select("c_custkey", lon.alias("lon"), lat.alias("lat"))
    return zone_of(points, zones, name="tz").select("c_custkey", "tz")


def map_features(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").select("n_name", "n_nationkey", (F.col("n_nationkey") + 0.5).alias("lon"), F.when(F.col("n_nationkey") != 3, F.col("n_regionkey") - 0.25).alias("lat"))
    return pages.features(rows, "lon", "lat", ["n_name", "n_nationkey"])


def page_rows(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 4 != 0, F.concat("n_name", F.lit(" <&>"))).alias("name"))
    return pages.html_rows(rows, "line").unionByName(rows.filter("n_nationkey = 1").select(pages.caption(F.col("name"), "tab:nations", "Sort by a click.").alias("line")))


# ---- a service -------------------------------------------------------------------------------------------


def _pulled(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nations as stations, each asked for as many days as its region's number; the service doesn't know some."""

    def transport(station: str, days: int):
        if int(station.split("_")[1]) % 8 == 5:
            raise LookupError(station)
        return [{"STATION_NUMBER": station, "Parameter": 5.0, "Date": datetime(2024, 1, 1) + timedelta(days=i), "Value": float(i)} for i in range(days)]

    rows = _table(spark, sf_dir, "nation").select("n_name", "n_regionkey").orderBy("n_nationkey").collect()  # 25 rows
    return pull(spark, transport, [r[0] for r in rows], HARVESTED.replace(tzinfo=UTC), [r[1] for r in rows], chunk=4)


def station_pull(spark, sf_dir):
    return _pulled(spark, sf_dir)[0].select("STATION_NUMBER", "Parameter", "Value", F.date_format("harvested_at", "yyyyMMdd").alias("harvested"))


def station_failures(spark, sf_dir):
    return _pulled(spark, sf_dir)[1]


def queries() -> dict:
    every = [
        snapshot_tree, snapshot_rerun, files_union, file_single, sql_over_file, sql_text_filter, catalog_province, station_csv, source_optional, csv_two_section, file_listing, sqlite_scan,
        table_fields, cached_result, export_columns, view_sql, mirror_plan, columns_range, columns_first, columns_clean, columns_without, columns_drop, column_constant, column_pull, columns_null,
        types_conformed, type_report, null_filter, historic_shape, instants, parameter_names, grouped_numbers, date_shift, points_wkb, time_zones, map_features, page_rows, station_pull, station_failures,
    ]
    return {f.__name__: f for f in every}


_HEX = {0: "0" * 16, 1: "000000000000F03F", 2: "0000000000000040"}
_CODE = "CASE event_type WHEN 'view' THEN 5.0::DOUBLE WHEN 'click' THEN 6.0::DOUBLE ELSE 46.0::DOUBLE END"
_REGION = "CAST(n_regionkey AS VARCHAR)"
_ESCAPED = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


def _hex_of(column: str) -> str:
    return f"CASE {column} {' '.join(f"WHEN {k} THEN '{v}'" for k, v in _HEX.items())} END"


def oracle_sql() -> dict[str, str]:
    return {
        "snapshot_tree": f"""SELECT STATION_NUMBER, "Parameter", "Date", "Value" FROM (SELECT *, row_number() OVER (PARTITION BY STATION_NUMBER, "Parameter", "Date" ORDER BY v DESC, "Value" DESC) AS rn FROM (
            SELECT CAST(user_id AS VARCHAR) AS STATION_NUMBER, {_CODE} AS "Parameter", ts AS "Date", value AS "Value", 1 AS v FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00'
            UNION ALL SELECT CAST(user_id AS VARCHAR), {_CODE}, ts, value + 1.0, 2 FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00') a WHERE "Parameter" IN (5, 6)) b WHERE rn = 1""",
        "snapshot_rerun": "SELECT count(*) AS n, max(value) AS top, true AS refused FROM events WHERE event_type = 'view'",
        "files_union": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 2 <> 0 THEN o_totalprice END AS o_totalprice FROM orders",
        "file_single": "SELECT * FROM region",
        "sql_over_file": "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus",
        "sql_text_filter": "SELECT p_partkey FROM part WHERE CAST(p_size AS VARCHAR) = '5'",
        "catalog_province": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
        "station_csv": "SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS station FROM supplier",
        "source_optional": "SELECT 'here' AS \"of\", count(*) AS n, max(n_name) AS last FROM nation",
        "csv_two_section": f"""SELECT 'ST' || {_REGION} AS STATION_NUMBER, CASE WHEN n_regionkey % 2 = 0 THEN '5' ELSE '46' END AS "Parameter", 'QR' AS "Code", CASE WHEN n_regionkey % 2 = 0 THEN 'Water temperature' END AS "Name_En",
            CASE WHEN n_nationkey % 7 <> 3 THEN '2024-01-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') END AS day, n_name AS "Value", CASE WHEN n_regionkey = 1 THEN 'Final' END AS "Approval" FROM nation""",
        "file_listing": "SELECT DISTINCT event_type, true AS filled FROM events",
        "sqlite_scan": "SELECT CAST(n_nationkey AS BIGINT) AS key, n_name AS name, CAST(n_regionkey AS BIGINT) AS region FROM nation",
        "table_fields": "SELECT place, field, true AS listed, (SELECT count(*) FROM nation) AS n_rows FROM (VALUES (0, 'n_nationkey'), (1, 'n_name'), (2, 'n_regionkey')) x(place, field)",
        "cached_result": "SELECT event_type, max(value) AS top FROM events GROUP BY event_type",
        "export_columns": "SELECT c_custkey, c_acctbal FROM customer",
        "view_sql": "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey",
        "mirror_plan": "SELECT * FROM (VALUES ('copy', 'view'), ('copy', 'click'), ('delete', 'error'), ('keep', 'view'), ('keep', 'click')) x(action, event_type)",
        "columns_range": "SELECT c_custkey, c_name, c_nationkey FROM customer",
        "columns_first": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
        "columns_clean": "SELECT r_regionkey AS region_key_id_, r_name AS r_name FROM region",
        "columns_without": "SELECT c_name, c_acctbal, c_mktsegment FROM customer",
        "columns_drop": "SELECT n_nationkey, n_name FROM nation",
        "column_constant": "SELECT *, 'delivery' AS source, 7 AS run FROM region",
        "column_pull": "SELECT DISTINCT c_nationkey FROM customer",
        "columns_null": "SELECT *, nullif(n_regionkey, 1) AS some FROM nation",
        "types_conformed": "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, TRY_CAST(p_brand AS DOUBLE) AS p_brand, p_name FROM part",
        "type_report": "SELECT * FROM (VALUES ('n_nationkey', 'old', 'int'), ('n_nationkey', 'new', 'string')) x(\"column\", frame, type)",
        "null_filter": "SELECT n_regionkey = 2 AS missing, count(*) AS n, count(nullif(n_regionkey, 2)) AS n_known FROM nation GROUP BY 1",
        "historic_shape": "SELECT '0' || user_id AS STATION_NUMBER, 5.0::DOUBLE AS \"Parameter\", ts AS \"Date\", CAST(NULL AS DOUBLE) AS \"Value\", event_type AS \"Qualifier\", CAST(NULL AS DOUBLE) AS \"Grade\" FROM events",
        "instants": "SELECT n_nationkey, CASE WHEN n_nationkey % 14 BETWEEN 1 AND 12 THEN '2024' || lpad(CAST(n_nationkey % 14 AS VARCHAR), 2, '0') || '05060708' END AS t FROM nation",
        "parameter_names": "SELECT p_partkey, CAST(p_size AS VARCHAR) AS code, CASE p_size WHEN 5 THEN 'Water temperature' WHEN 6 THEN 'Discharge (daily mean)' END AS name_en FROM part",
        "grouped_numbers": "SELECT p_partkey, format('{:,}', p_partkey * 12345) AS shown FROM part",
        "date_shift": "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS next, CAST(o_orderdate AS DATE) - 180 AS half_year_before, CAST(o_orderdate AS DATE) + CAST(o_custkey % 5 AS INTEGER) AS later FROM orders",
        "points_wkb": f"SELECT n_nationkey, lon, lat, '0101000000' || {_hex_of('lon')} || {_hex_of('lat')} AS geometry FROM (SELECT n_nationkey, CAST(n_nationkey % 3 AS DOUBLE) AS lon, CASE WHEN n_nationkey % 5 <> 0 THEN CAST(n_regionkey % 2 AS DOUBLE) END AS lat FROM nation) p",
        "time_zones": """SELECT c_custkey, CASE WHEN x > 0 AND x < 10 AND y > 0 AND y < 8 THEN 'box' WHEN y > 8 AND y < x + 8 AND y < 18 - x THEN 'wedge' END AS tz
            FROM (SELECT c_custkey, (c_custkey % 71) * 0.37 - 10.013 AS x, (c_custkey % 53) * 0.41 - 5.017 AS y FROM customer) p""",
        "map_features": """SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || CAST(n_nationkey + 0.5::DOUBLE AS VARCHAR) || ',' || CAST(n_regionkey - 0.25::DOUBLE AS VARCHAR) || ']},"properties":{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || '}}' AS feature FROM nation WHERE n_nationkey <> 3""",
        "page_rows": f"""SELECT '<tr><td>' || n_nationkey || '</td><td>' || CASE WHEN n_nationkey % 4 <> 0 THEN {_ESCAPED.format("n_name || ' <&>'")} ELSE '' END || '</td></tr>' AS line FROM nation
            UNION ALL SELECT '<caption>(tab:nations) ' || {_ESCAPED.format("n_name || ' <&>'")} || ' <b>Sort by a click.</b></caption>' FROM nation WHERE n_nationkey = 1""",
        "station_pull": "SELECT n_name AS STATION_NUMBER, 5.0::DOUBLE AS \"Parameter\", CAST(i AS DOUBLE) AS \"Value\", '20240201' AS harvested FROM nation, range(5) r(i) WHERE i < n_regionkey AND n_nationkey % 8 <> 5",
        "station_failures": "SELECT n_name AS STATION_NUMBER, 'LookupError: ' || n_name AS error FROM nation WHERE n_nationkey % 8 = 5",
    }
