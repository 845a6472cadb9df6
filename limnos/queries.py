"""The engine's queries over the driver's tables, and the SQL that each equals.

`events` stands in for readings (station: user_id, parameter: event_type, time: ts, key: user, type and day),
`lineitem` for overlapping deliveries and `customer` for stations.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos import file_queries
from limnos.functions.scalars import case, chunk_of, days_between, number, snapshot_name, stamped
from limnos.functions.timebounds import literal
from limnos.operators import latest, sets, tidy
from limnos.operators.amalgamate import amalgamate, overlap_counts
from limnos.plans.canonical import Readings
from limnos.plans.staging import fresh_path
from limnos.sinks.snapshots import export

EVENTS = Readings("user_id", "event_type", "ts", "value", "ts", ["user_id", "event_type", "day"], ["event_id"])
COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
MERGE = ["k1", "k2", "v", "d"]
OVERLAP = (datetime(1998, 1, 1), datetime(1999, 1, 1))


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


def _canonical(**bounds):
    return lambda spark, sf_dir: EVENTS.query(_events(spark, sf_dir), **bounds).select(*COLUMNS)


def _delivery(spark, sf_dir: str, first: bool) -> DataFrame:
    """Two deliveries of lineitem that overlap by a year and hold all of it, with nulls among the key columns and a payload column each."""
    day = F.col("l_shipdate")
    rows = _table(spark, sf_dir, "lineitem").filter(day < literal(OVERLAP[1], naive=True) if first else day >= literal(OVERLAP[0], naive=True))
    payload = F.col("l_returnflag").alias("p") if first else F.col("l_linestatus").alias("q")
    return rows.select(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), F.nullif("l_quantity", F.lit(7.0)).alias("v"), payload, F.col("l_shipdate").alias("d"))


def _both(work):
    return lambda spark, sf_dir: work(_delivery(spark, sf_dir, True), _delivery(spark, sf_dir, False))


def _on_keys(work):
    return _both(lambda a, b: work(a.select(*MERGE), b.select(*MERGE)))


def series_single(spark, sf_dir):
    return EVENTS.series(_events(spark, sf_dir), "view", 7, columns=["user_id", "ts", "value"])


def daily_mean(spark, sf_dir):
    return EVENTS.daily_mean(EVENTS.query(_events(spark, sf_dir)), "mean_c")


def latest_per_station(spark, sf_dir):
    return EVENTS.latest(EVENTS.query(_events(spark, sf_dir), ["view"])).select("user_id", "ts", "value")


def station_range(spark, sf_dir):
    return EVENTS.ranges(EVENTS.query(_events(spark, sf_dir), ["view"]))


def station_table(spark, sf_dir):
    stations = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return EVENTS.station_table(stations, EVENTS.query(_events(spark, sf_dir), ["view"]), "c_custkey")


def snapshot_summary(spark, sf_dir):
    return EVENTS.summary(_table(spark, sf_dir, "events"))


def station_param_range(spark, sf_dir):
    ranges = EVENTS.ranges(_table(spark, sf_dir, "events"), ["user_id", "event_type"])
    return ranges.withColumn("days_since", days_between(F.to_date("max_date"), F.lit(date(2024, 3, 1))))


def distinct_stations(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("user_id").distinct()


def distinct_keep_first(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    rows = _table(spark, sf_dir, "lineitem").select(*columns)
    return latest.keep_first(rows, columns[:2], ["l_shipdate", "l_partkey", "l_suppkey"])


def duplicate_rows(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return latest.repeated(_table(spark, sf_dir, "lineitem").select(*columns), columns[:2])


def count_by_parameter(spark, sf_dir):
    dimension = spark.createDataFrame([("view", "V"), ("click", "C")], "event_type string, code string")
    return EVENTS.counts(_table(spark, sf_dir, "events"), dimension)


def semi_membership(spark, sf_dir):
    return sets.members(_table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", _table(spark, sf_dir, "events"), "user_id")


def anti_missing(spark, sf_dir):
    return sets.missing(_table(spark, sf_dir, "customer"), "c_custkey", _table(spark, sf_dir, "events"), "user_id")


def case_when_name(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", case(F.col("event_type"), {"view": "Water temperature", "click": "Discharge (daily mean)"}).alias("name_en"))


def safe_cast(spark, sf_dir):
    part = _table(spark, sf_dir, "part").withColumn("tail", F.substring("p_brand", 7, 2**31 - 1))
    return part.select("p_partkey", number("tail").alias("v"), number("p_type").alias("bad"))


def na_poison_max(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.nullif("l_quantity", F.lit(7.0)).alias("v"))
    return rows.agg(tidy.strict_max("v").alias("m_strict"), F.max("v").alias("m"))


def values_range(spark, sf_dir):
    """First and last time of each type; of errors one time is missing, which makes both unknown."""
    lo, hi = tidy.strict_range("t")
    rows = _table(spark, sf_dir, "events").withColumn("t", F.when((F.col("event_type") != "error") | (F.col("user_id") % 2 == 0), F.col("ts")))
    return rows.groupBy("event_type").agg(lo.alias("lo"), hi.alias("hi"))


def station_chunks(spark, sf_dir):
    stations = _table(spark, sf_dir, "events").select("user_id").distinct()
    return tidy.numbered(stations, ["user_id"]).select(chunk_of(F.col("ordinal")).alias("chunk"), "user_id")


def page_sorted(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return tidy.page(rows, [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey")], 10)


def fill_down(spark, sf_dir):
    rows = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.nullif("s_nationkey", F.lit(20)).alias("filled"))
    return tidy.fill_down(rows, ["filled"], ["s_nationkey", "s_suppkey"]).select("s_suppkey", "filled")


def stamped_name(spark, sf_dir):
    return _table(spark, sf_dir, "events").filter("event_type = 'view'").agg(stamped("readings", tidy.strict_max("ts")).alias("out_table"))


def snapshot_path(spark, sf_dir):
    return _table(spark, sf_dir, "events").agg(snapshot_name(F.max("ts")).alias("p"))


def limit_export(spark, sf_dir):
    """Any 1000 rows of a table, exported: how many there are, and how many of them the table has."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    rows = _table(spark, sf_dir, "lineitem").select(*keys)
    some = spark.read.parquet(export(rows, fresh_path(spark, "limit"), keys, 1000))
    return some.join(rows.distinct().withColumn("there", F.lit(1)), keys, "left").agg(F.count("*").alias("n"), F.count("there").alias("n_of_table"))


def queries() -> dict:
    return {
        "canonical_all": _canonical(),
        "canonical_parameter": _canonical(parameter=["view", "click"]),
        "canonical_stations": _canonical(stations=[3, 7, 11]),
        "canonical_to_date": _canonical(start=date(2024, 1, 5), end=date(2024, 1, 10)),
        "canonical_to_instant": _canonical(start=date(2024, 1, 5), end=datetime(2024, 1, 10)),
        "canonical_days_back": _canonical(days_back=7, as_of=date(2024, 1, 25)),
        "series_single": series_single,
        "daily_mean": daily_mean,
        "latest_per_station": latest_per_station,
        "station_range": station_range,
        "station_table": station_table,
        "snapshot_summary": snapshot_summary,
        "station_param_range": station_param_range,
        "distinct_stations": distinct_stations,
        "distinct_keep_first": distinct_keep_first,
        "duplicate_rows": duplicate_rows,
        "keys_union": _on_keys(sets.rows_union),
        "keys_intersect": _on_keys(sets.rows_intersect),
        "keys_setdiff": _on_keys(sets.rows_difference),
        "bind_rows": _both(sets.bind_rows),
        "natural_left_join": _both(lambda a, b: sets.natural_left_join(a, b.distinct())),
        "amalgamate": _both(lambda a, b: amalgamate(a, b, MERGE)),
        "amalgamate_count_identity": _both(lambda a, b: overlap_counts(a, b, MERGE)),
        "count_by_parameter": count_by_parameter,
        "semi_membership": semi_membership,
        "anti_missing": anti_missing,
        "case_when_name": case_when_name,
        "safe_cast": safe_cast,
        "na_poison_max": na_poison_max,
        "values_range": values_range,
        "station_chunks": station_chunks,
        "page_sorted": page_sorted,
        "fill_down": fill_down,
        "stamped_name": stamped_name,
        "snapshot_path": snapshot_path,
        "limit_export": limit_export,
        **file_queries.queries(),
    }


_A = "SELECT l_orderkey AS k1, l_linenumber AS k2, CAST(nullif(l_quantity, 7) AS DOUBLE) AS v, l_returnflag AS p, l_shipdate AS d FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01 00:00:00'"
_B = "SELECT l_orderkey AS k1, l_linenumber AS k2, CAST(nullif(l_quantity, 7) AS DOUBLE) AS v, l_linestatus AS q, l_shipdate AS d FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'"
_SAME = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in MERGE)


def _can(where: str = "") -> str:
    return f"""SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events {where}) x WHERE rn = 1"""


def oracle_sql() -> dict[str, str]:
    keys = ", ".join(MERGE)
    pair = f"WITH a AS ({_A}), b AS ({_B}), ka AS (SELECT {keys} FROM a), kb AS (SELECT {keys} FROM b)"
    view = _can("WHERE event_type = 'view'")
    ranges = f"SELECT user_id, min(ts) AS min_date, max(ts) AS max_date FROM ({view}) c GROUP BY user_id"
    return {
        "canonical_all": _can(),
        "canonical_parameter": _can("WHERE event_type IN ('view', 'click')"),
        "canonical_stations": _can("WHERE user_id IN (3, 7, 11)"),
        "canonical_to_date": _can("WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'"),
        "canonical_to_instant": _can("WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-10 00:00:00'"),
        "canonical_days_back": _can("WHERE ts >= TIMESTAMP '2024-01-18 00:00:00'"),
        "series_single": f"SELECT user_id, ts, value FROM ({_can("WHERE event_type = 'view' AND user_id = 7")}) c ORDER BY ts",
        "daily_mean": f"SELECT user_id, CAST(ts AS DATE) AS date_day, avg(value) AS mean_c, count(*) AS n_obs FROM ({_can()}) c GROUP BY ALL",
        "latest_per_station": f"SELECT user_id, ts, value FROM (SELECT c.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS r2 FROM ({view}) c) y WHERE r2 = 1",
        "station_range": ranges,
        "station_table": f"SELECT s.c_custkey, s.c_name, r.min_date, r.max_date FROM customer s LEFT JOIN ({ranges}) r ON s.c_custkey IS NOT DISTINCT FROM r.user_id",
        "snapshot_summary": "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS stations, min(ts) AS min_date, max(ts) AS max_date FROM events",
        "station_param_range": "SELECT user_id, event_type, min(ts) AS min_date, max(ts) AS max_date, datediff('day', CAST(max(ts) AS DATE), DATE '2024-03-01') AS days_since FROM events GROUP BY user_id, event_type",
        "distinct_stations": "SELECT DISTINCT user_id FROM events",
        "distinct_keep_first": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem) x WHERE rn = 1",
        "duplicate_rows": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) x WHERE n > 1",
        "keys_union": f"{pair} SELECT * FROM ka UNION SELECT * FROM kb",
        "keys_intersect": f"{pair} SELECT * FROM ka INTERSECT SELECT * FROM kb",
        "keys_setdiff": f"{pair} SELECT * FROM ka EXCEPT SELECT * FROM kb",
        "bind_rows": f"{pair} SELECT {keys}, p, CAST(NULL AS VARCHAR) AS q FROM a UNION ALL SELECT {keys}, CAST(NULL AS VARCHAR), q FROM b",
        "natural_left_join": f"{pair} SELECT a.*, b.q FROM a LEFT JOIN (SELECT DISTINCT * FROM b) b ON {_SAME}",
        "amalgamate": f"{pair} SELECT {keys}, p, CAST(NULL AS VARCHAR) AS q FROM a UNION ALL SELECT {keys}, CAST(NULL AS VARCHAR), q FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE {_SAME})",
        "amalgamate_count_identity": f"""{pair} SELECT (SELECT count(*) FROM (SELECT * FROM ka INTERSECT SELECT * FROM kb) i) AS n_both,
            (SELECT count(*) FROM (SELECT DISTINCT * FROM ka) i) + (SELECT count(*) FROM (SELECT DISTINCT * FROM kb) i) - (SELECT count(*) FROM (SELECT * FROM ka UNION SELECT * FROM kb) i) AS n_identity""",
        "count_by_parameter": "SELECT c.event_type, c.n_events, d.code FROM (SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type) c LEFT JOIN (VALUES ('view', 'V'), ('click', 'C')) AS d(event_type, code) ON c.event_type IS NOT DISTINCT FROM d.event_type",
        "semi_membership": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT DISTINCT user_id FROM events)",
        "anti_missing": "SELECT DISTINCT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)",
        "case_when_name": "SELECT event_id, CASE WHEN event_type = 'view' THEN 'Water temperature' WHEN event_type = 'click' THEN 'Discharge (daily mean)' ELSE NULL END AS name_en FROM events",
        "safe_cast": "SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS DOUBLE) AS v, TRY_CAST(p_type AS DOUBLE) AS bad FROM part",
        "na_poison_max": "SELECT CASE WHEN count(*) = count(v) THEN max(v) END AS m_strict, max(v) AS m FROM (SELECT nullif(l_quantity, 7) AS v FROM lineitem) x",
        "values_range": "SELECT event_type, CASE WHEN count(*) = count(t) THEN min(t) END AS lo, CASE WHEN count(*) = count(t) THEN max(t) END AS hi FROM (SELECT event_type, CASE WHEN event_type <> 'error' OR user_id % 2 = 0 THEN ts END AS t FROM events) x GROUP BY event_type",
        "station_chunks": "SELECT CAST(ceil(row_number() OVER (ORDER BY user_id) / 50.0) AS INTEGER) AS chunk, user_id FROM (SELECT DISTINCT user_id FROM events) u",
        "page_sorted": "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
        "fill_down": "SELECT s_suppkey, last_value(z IGNORE NULLS) OVER (ORDER BY s_nationkey ASC NULLS LAST, s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM (SELECT s_suppkey, s_nationkey, nullif(s_nationkey, 20) AS z FROM supplier) s",
        "stamped_name": "SELECT 'readings_' || strftime(max(ts), '%Y%m%d') AS out_table FROM events WHERE event_type = 'view'",
        "snapshot_path": "SELECT strftime(max(ts), '%Y/%m/snapshot_%Y-%m-%d') AS p FROM events",
        "limit_export": "SELECT count(*) AS n, count(*) AS n_of_table FROM (SELECT * FROM lineitem LIMIT 1000) x",
        **file_queries.oracle_sql(),
    }
