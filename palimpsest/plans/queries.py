"""Registered queries, one or more for each operator, with the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import FROM, LOAD, OPEN, SOURCE, TO, moment
from ..operators import control, extract, layout, maintenance, metadata, schema_sync, timemap, transitions
from . import matching
from .fixtures import fixture, frame, with_fixtures

BEGIN, END, AT = datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2024, 2, 1)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
T_BEGIN, T_END, T_AT = (f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'" for t in (BEGIN, END, AT))
OPEN_SQL = "TIMESTAMP '9999-12-31 00:00:00'"


def query(sql: str, far: str | None = None):
    """Registers a query under its function's name; sql may name fixtures.

    far: a column that may hold the far end of time, which some clients' types can't; it is given as text.
    """

    def add(f):
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumn(far, F.date_format(far, "yyyy-MM-dd HH:mm:ss.SSS")) if far else df

        QUERIES[f.__name__] = run
        text = with_fixtures(sql)
        ORACLE[f.__name__] = f"SELECT * REPLACE (strftime({far}, '%Y-%m-%d %H:%M:%S.%g') AS {far}) FROM ({text}) AS rows" if far else text
        return run

    return add


# ---- inputs ----


def lake(spark: SparkSession, sf: str) -> DataFrame:
    """The history of `events`: T3 on an empty target."""
    return transitions.cdc_collapse(fixture(spark, sf, "f_cdc"), fixture(spark, sf, "f_time"), ["k"], datetime(1900, 1, 1), OPEN)


def old_side(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "f_old_rows")
    return rows.select(moment(BEGIN).alias(FROM), moment(OPEN).alias(TO), moment(BEGIN).alias(LOAD), "__action", "__source", "k", "a", "p")


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "f_new_rows").drop(SOURCE)


def state(history: DataFrame, at: datetime) -> DataFrame:
    """A published table as it was at an instant."""
    return extract.as_of(history, at).drop(TO)


OLD_SIDE = f"old_side AS (SELECT {T_BEGIN} AS __from, {OPEN_SQL} AS __to, {T_BEGIN} AS __load, __action, __source, k, a, p FROM f_old_rows)"
DIFF = """
u AS (SELECT k, a, p, __source, CASE WHEN __action = 'X' THEN 'I' ELSE __action END AS o, NULL AS n FROM f_old_rows
      UNION ALL SELECT k, a, p, __source, NULL, 'I' FROM f_new_rows),
g AS (SELECT k, a, p, __source, MAX(o) AS o, MAX(n) AS n FROM u GROUP BY k, a, p, __source HAVING COUNT(*) <> 2),
w AS (SELECT *, MAX(o) OVER (PARTITION BY k, __source) AS mo, MAX(n) OVER (PARTITION BY k, __source) AS mn FROM g),
acts AS (SELECT k, a, p, __source, o AS side_old, n AS side_new,
                CASE WHEN mo IS NULL THEN 'I' WHEN mo IN ('I', 'U') THEN CASE WHEN mn IS NULL THEN 'D' ELSE 'U' END
                     WHEN mn IS NULL THEN 'Z' ELSE 'I' END AS __action FROM w)"""
LIVE = f"published AS (SELECT __from, __load, __action, __source, k, v FROM f_lak WHERE __from <= {T_BEGIN} AND __to > {T_BEGIN} AND __action <> 'D')"
NET = f"""
x AS (SELECT *, FIRST_VALUE(__action) OVER (PARTITION BY k, __source ORDER BY __from) AS fa FROM f_lak WHERE __from > {T_BEGIN} AND __from <= {T_END}),
net AS (SELECT __from, __to, __load, CASE WHEN __action = 'D' THEN 'D' WHEN fa = 'I' THEN 'I' ELSE 'U' END AS __action, __source, k, v FROM x WHERE __to > {T_END})"""

# ---- T: transitions ----


@query(f"""WITH {OLD_SIDE}, u AS (SELECT k, a, p, __source, 0 AS new FROM old_side WHERE __to = {OPEN_SQL} UNION ALL SELECT k, a, p, __source, 1 FROM f_new_rows)
SELECT TIMESTAMP '1900-01-01' AS __from, {OPEN_SQL} AS __to, {T_AT} AS __load, 'X' AS __action, __source, k, a, p
FROM u GROUP BY k, a, p, __source HAVING COUNT(*) <> 2 AND MAX(new) = 1""", TO)
def baseline_load(spark, sf):
    return transitions.baseline_load(old_side(spark, sf), snapshot(spark, sf), AT).inserts


@query(f"SELECT {T_BEGIN} AS __from, {OPEN_SQL} AS __to, {T_AT} AS __load, 'X' AS __action, CAST(0 AS SMALLINT) AS __source, k, a, p FROM f_new_rows", TO)
def baseline_first(spark, sf):
    return transitions.baseline_first(old_side(spark, sf).limit(0), snapshot(spark, sf), BEGIN, AT).result


@query("SELECT * FROM f_lak", TO)
def cdc_collapse(spark, sf):
    return lake(spark, sf)


SPLIT = f"""
early AS (SELECT __from, CASE WHEN __to > {T_END} THEN {OPEN_SQL} ELSE __to END AS __to, __load, __action, __source, k, v FROM f_lak WHERE __from <= {T_END}),
late AS (SELECT k, MIN(__from) AS b FROM f_lak WHERE __from > {T_END} GROUP BY k)"""


def history_until(spark, sf, at: datetime) -> DataFrame:
    return transitions.cdc_collapse(fixture(spark, sf, "f_cdc"), fixture(spark, sf, "f_time"), ["k"], datetime(1900, 1, 1), at)


def late_batch(spark, sf):
    return transitions.cdc_history(history_until(spark, sf, END), fixture(spark, sf, "f_cdc"), fixture(spark, sf, "f_time"), ["k"], END, OPEN)


@query("SELECT * FROM f_lak", TO)
def cdc_history(spark, sf):
    return late_batch(spark, sf).result


@query(f"WITH {SPLIT} SELECT e.__from, l.b AS __to, e.__load, e.__action, e.__source, e.k, e.v FROM early AS e JOIN late AS l ON l.k = e.k WHERE e.__to = {OPEN_SQL}", TO)
def cdc_close(spark, sf):
    return late_batch(spark, sf).closes


@query(f"WITH {SPLIT}, n AS (SELECT CASE WHEN __action = 'D' THEN 'deleted' ELSE 'inserted' END AS what, COUNT(*) AS n FROM f_lak WHERE __from > {T_END} GROUP BY 1 UNION ALL SELECT 'updated', COUNT(*) FROM early AS e JOIN late AS l ON l.k = e.k WHERE e.__to = {OPEN_SQL}) SELECT what, n FROM n")
def cdc_counts(spark, sf):
    c = late_batch(spark, sf)
    count = lambda df, what: df.groupBy(F.lit(what).alias("what")).agg(F.count("*").alias("n"))
    return count(c.inserts, "inserted").unionByName(count(c.closes, "updated")).unionByName(count(c.tombstones, "deleted"))


@query(f"WITH {DIFF} SELECT k, a, p, __source, side_old, side_new FROM acts")
def snapshot_diff(spark, sf):
    return transitions.snapshot_actions(old_side(spark, sf).select("__action", "__source", "k", "a", "p"), fixture(spark, sf, "f_new_rows"), ["k"]).drop("__action")


@query(f"WITH {DIFF} SELECT k, a, p, __source, side_old, side_new, __action FROM acts")
def snapshot_actions(spark, sf):
    return transitions.snapshot_actions(fixture(spark, sf, "f_old_rows"), fixture(spark, sf, "f_new_rows"), ["k"])


@query(f"""WITH {OLD_SIDE}, {DIFF}, t AS (SELECT * FROM acts WHERE __action <> 'Z')
SELECT o.__from, CASE WHEN c.k IS NULL THEN o.__to ELSE {T_AT} END AS __to, o.__load, o.__action, o.__source, o.k, o.a, o.p
FROM old_side AS o LEFT JOIN (SELECT DISTINCT k, __source FROM t WHERE side_old IS NOT NULL) AS c ON c.k = o.k AND c.__source = o.__source
UNION ALL SELECT {T_AT}, {OPEN_SQL}, {T_AT}, __action, __source, k, a, p FROM t WHERE side_new IS NOT NULL
UNION ALL SELECT {T_AT}, {OPEN_SQL}, {T_AT}, __action, __source, k, a, p FROM t WHERE side_new IS NULL AND __action = 'D'""", TO)
def snapshot_apply(spark, sf):
    return transitions.snapshot_apply(old_side(spark, sf), snapshot(spark, sf), ["k"], AT).result


def _utc(c: str) -> str:
    return f"CAST(({c} AT TIME ZONE 'Europe/London') AT TIME ZONE 'UTC' AS TIMESTAMP)"


LEGACY = "m AS (SELECT *, MIN(DateFrom) OVER () AS g, MIN(DateFrom) OVER (PARTITION BY k) AS kf, MAX(DateTo) OVER (PARTITION BY k) AS kt FROM f_old)"


@query(f"WITH {LEGACY} SELECT {_utc('DateFrom')} AS __from, CASE WHEN DateTo = {OPEN_SQL} THEN DateTo ELSE {_utc('DateTo')} END AS __to, {_utc('DateFrom')} AS __load, CASE WHEN DateFrom = g THEN 'X' WHEN DateFrom = kf THEN 'I' ELSE 'U' END AS __action, CAST(0 AS SMALLINT) AS __source, k, v FROM m", TO)
def legacy_convert(spark, sf):
    return transitions.legacy_convert(fixture(spark, sf, "f_old"), ["k"]).inserts


@query(f"WITH {LEGACY} SELECT {_utc('DateTo')} AS __from, {OPEN_SQL} AS __to, {_utc('DateFrom')} AS __load, 'D' AS __action, CAST(0 AS SMALLINT) AS __source, k, v FROM m WHERE kt <> {OPEN_SQL} AND kt = DateTo", TO)
def legacy_tombstones(spark, sf):
    return transitions.legacy_convert(fixture(spark, sf, "f_old"), ["k"]).tombstones


@query(f"SELECT __from, CASE WHEN __to > {T_END} THEN {OPEN_SQL} ELSE __to END AS __to, __load, __action, __source, k, v FROM f_lak WHERE __from <= {T_END}", TO)
def propagate_history(spark, sf):
    changes = extract.all_changes(lake(spark, sf), BEGIN, END)
    return transitions.propagate_history(history_until(spark, sf, BEGIN), changes, ["k"], BEGIN, END).result


def _published(spark, sf):
    h = lake(spark, sf)
    return transitions.publish(state(h, BEGIN), extract.net_changes(h, ["k"], BEGIN, END), ["k"])


@query(f"""WITH {LIVE}, {NET}, up AS (SELECT * FROM net WHERE __action IN ('I', 'U'))
SELECT COALESCE(u.__from, p.__from) AS __from, COALESCE(u.__load, p.__load) AS __load, COALESCE(u.__action, p.__action) AS __action, COALESCE(u.__source, p.__source) AS __source, COALESCE(u.k, p.k) AS k,
       CASE WHEN u.k IS NOT NULL THEN u.v ELSE p.v END AS v
FROM published AS p FULL JOIN up AS u ON u.k = p.k AND u.__source = p.__source
WHERE COALESCE(u.k, p.k) NOT IN (SELECT k FROM net WHERE __action = 'D')""")
def publish_upsert(spark, sf):
    return _published(spark, sf).result


@query(f"WITH {LIVE}, {NET} SELECT p.* FROM published AS p WHERE p.k IN (SELECT k FROM net WHERE __action = 'D')")
def publish_delete(spark, sf):
    return _published(spark, sf).tombstones


C_BEGIN, C_END = datetime(2024, 7, 10), datetime(2024, 7, 20)
TC_BEGIN, TC_END = (f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'" for t in (C_BEGIN, C_END))


@query(f"""WITH target AS (SELECT k, v FROM f_old WHERE DateFrom <= {TC_BEGIN} AND DateTo > {TC_BEGIN}),
cur AS (SELECT k, v FROM f_old WHERE DateFrom > {TC_BEGIN} AND DateFrom <= {TC_END} AND DateTo > {TC_END}),
gone AS (SELECT k FROM f_old WHERE (DateFrom > {TC_BEGIN} AND DateFrom <= {TC_END} AND DateTo > {TC_END}) OR (DateTo > {TC_BEGIN} AND DateTo <= {TC_END} AND DateFrom <= {TC_BEGIN})
         GROUP BY k HAVING COUNT(*) = 1 AND MIN(DateFrom) <= {TC_BEGIN})
SELECT COALESCE(c.k, t.k) AS k, CASE WHEN c.k IS NOT NULL THEN c.v ELSE t.v END AS v FROM target AS t FULL JOIN cur AS c ON c.k = t.k WHERE COALESCE(c.k, t.k) NOT IN (SELECT k FROM gone)""")
def copy_net(spark, sf):
    h = fixture(spark, sf, "f_old")
    target = h.where((F.col("DateFrom") <= moment(C_BEGIN)) & (F.col("DateTo") > moment(C_BEGIN))).select("k", "v")
    return transitions.copy_net(target, h, ["k"], C_BEGIN, C_END).result


# ---- R, V: extraction and views ----


@query(f"WITH {NET} SELECT * FROM net", TO)
def net_changes(spark, sf):
    return extract.net_changes(lake(spark, sf), ["k"], BEGIN, END)


@query(f"SELECT * FROM f_lak WHERE (__from > {T_BEGIN} AND __from <= {T_END}) OR (__from <= {T_BEGIN} AND __to > {T_BEGIN} AND __to <= {T_END})", TO)
def all_changes(spark, sf):
    return extract.all_changes(lake(spark, sf), BEGIN, END)


@query(f"SELECT * FROM f_lak WHERE __from > {T_BEGIN} AND __from <= {T_END} AND __to > TIMESTAMP '2024-01-15 00:00:00'", TO)
def retention_extract(spark, sf):
    return extract.began(lake(spark, sf), BEGIN, END, datetime(2024, 1, 15))


@query(f"SELECT * FROM f_lak WHERE __to = {OPEN_SQL} AND __action <> 'D'", TO)
def current_view(spark, sf):
    return extract.current(lake(spark, sf))


@query(f"SELECT * FROM f_lak WHERE __from <= {T_END} AND __to > {T_END} AND __action <> 'D'", TO)
def as_of_view(spark, sf):
    return extract.as_of(lake(spark, sf), END)


# ---- M: time map ----

EVENT_MAP = "SELECT event_id AS lsn, ts AS tran_end_time FROM events"


def _log(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("lsn"), F.col("ts").cast("timestamp_ntz").alias("tran_end_time"))


def _hourly(spark, sf) -> DataFrame:
    f = fixture(spark, sf, "f_time")
    return f.select("lsn", F.col(FROM).alias("tran_end_time"))


@query("SELECT lsn, __from AS tran_end_time, CAST(epoch_us(CAST((__from AT TIME ZONE 'Europe/London') AT TIME ZONE 'UTC' AS TIMESTAMP)) * 10 + ROW_NUMBER() OVER (PARTITION BY __from ORDER BY lsn) AS BIGINT) AS __from FROM f_time")
def time_map_rank(spark, sf):
    return timemap.rank_map(_hourly(spark, sf))


@query("""WITH s AS (SELECT scn_dt, min_scn, LEAD(min_scn - 1, 1, max_scn) OVER (ORDER BY min_scn) AS max_scn FROM f_scn)
SELECT e.event_id AS lsn, e.event_id AS scn, s.scn_dt, s.min_scn, s.max_scn, CAST(epoch_us(CAST((s.scn_dt AT TIME ZONE 'Europe/London') AT TIME ZONE 'UTC' AS TIMESTAMP)) * 10 + e.event_id - s.min_scn + 1 AS BIGINT) AS __from
FROM events AS e JOIN s ON e.event_id BETWEEN s.min_scn AND s.max_scn""")
def scn_range_map(spark, sf):
    return timemap.scn_map(_log(spark, sf).select("lsn"), fixture(spark, sf, "f_scn"), width=256).select("lsn", "scn", "scn_dt", "min_scn", "max_scn", FROM)


@query(f"SELECT {T_END} AS __from, CAST(443404800 + 86400 * 3 AS BIGINT) - CAST(86400 * 3 AS BIGINT) AS lsn, {T_BEGIN} AS tran_begin_time, {T_END} AS tran_end_time")
def time_map_synthetic(spark, sf):
    return timemap.synthetic(spark, BEGIN, END, AT)


NOW = datetime(2024, 3, 1, 12, 30, 15)


@query("SELECT event_id AS lsn, CASE WHEN event_id % 10 = 0 THEN CAST(event_id AS BIGINT) ELSE CAST(epoch_us(TIMESTAMP '2024-03-01 12:30:15') * 10 + ROW_NUMBER() OVER (ORDER BY event_id) AS BIGINT) END AS __load FROM events")
def load_stamp(spark, sf):
    rows = _log(spark, sf).select("lsn", F.when(F.col("lsn") % 10 == 0, F.col("lsn")).alias(LOAD))
    return timemap.stamp_load(rows, NOW)


DST = "SELECT CAST(lsn AS BIGINT) AS lsn, CAST(t AS TIMESTAMP_NTZ) AS t FROM (VALUES (1, '2024-10-26 23:59:00'), (2, '2024-10-27 00:10:00'), (3, '2024-10-27 00:50:00'), (4, '2024-10-27 00:05:00'), (5, '2024-10-27 00:40:00'), (6, '2024-10-27 02:00:00'), (7, '2025-10-26 00:30:00'), (8, '2025-10-26 00:20:00'), (9, '2025-11-02 00:30:00')) AS v(lsn, t)"


@query(f"WITH d AS ({DST}) SELECT lsn, CAST(epoch_us(t) * 10 + CASE WHEN lsn IN (4, 5, 8) THEN 36000000000 ELSE 0 END AS BIGINT) AS __from FROM d")
def dst_repair(spark, sf):
    rows = frame(spark, DST)
    ticks = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("t")) * 10
    return timemap.repair_overlap(rows.select("lsn", ticks.alias(FROM)))


PAIR_S = "SELECT event_id AS lsn, CAST(epoch_us(ts) + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS __from, CAST(event_id AS BIGINT) AS __load FROM events WHERE event_id % 7 <> 0"
PAIR_T = "SELECT event_id AS lsn, CAST(epoch_us(ts) AS BIGINT) AS __from, CAST(event_id AS BIGINT) AS __load FROM events WHERE event_id % 11 <> 0"
DIFFERENCES = f"""s AS ({PAIR_S}), t AS ({PAIR_T}),
g AS (SELECT lsn, __from, __load, MAX(src) AS src FROM (SELECT 'S' AS src, * FROM s UNION ALL SELECT 'T', * FROM t) AS x GROUP BY lsn, __from, __load HAVING COUNT(*) <> 2),
d AS (SELECT CASE WHEN COUNT(*) OVER (PARTITION BY lsn) = 2 THEN CASE src WHEN 'S' THEN 'U+' ELSE 'U-' END WHEN src = 'S' THEN 'I' ELSE 'D' END AS upsert, lsn, __from, __load FROM g)"""


def _pair(spark, sf) -> tuple[DataFrame, DataFrame]:
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("tran_end_time"))
    rows = _log(spark, sf).select("lsn", micros.alias(FROM), F.col("lsn").alias(LOAD))
    changed = rows.withColumn(FROM, F.col(FROM) + F.when(F.col("lsn") % 5 == 0, 1).otherwise(0))
    return changed.where("lsn % 7 <> 0"), rows.where("lsn % 11 <> 0")


@query(f"WITH {DIFFERENCES} SELECT * FROM d")
def time_diff(spark, sf):
    return timemap.classify(*_pair(spark, sf))


@query(f"WITH {DIFFERENCES} SELECT lsn, __from, __load FROM t WHERE lsn NOT IN (SELECT lsn FROM d WHERE upsert IN ('U+', 'I')) UNION ALL SELECT lsn, __from, __load FROM d WHERE upsert IN ('U+', 'I')")
def time_upsert(spark, sf):
    source, target = _pair(spark, sf)
    return timemap.upsert(target, timemap.classify(source, target))


@query(f"WITH {DIFFERENCES} SELECT __from, __load FROM d WHERE upsert IN ('U+', 'I') ORDER BY __load DESC LIMIT 1")
def last_marks(spark, sf):
    return timemap.last_marks(timemap.classify(*_pair(spark, sf)))


@query(f"SELECT * FROM f_time WHERE __from > {T_BEGIN} AND __from <= {T_END}")
def time_pass_through(spark, sf):
    return timemap.pass_through(fixture(spark, sf, "f_time"), BEGIN, END)


# ---- H: metadata ----

CATALOG = """SELECT t AS TableName, CAST(i AS INT) AS ColumnId, c AS ColumnName, CAST(k AS INT) AS KeyId FROM (VALUES
('__$Complete', 1, 'CompleteDate', NULL), ('lsn_time_mapping', 1, 'start_lsn', 1), ('dbo_orders_CT', 1, '__$start_lsn', NULL), ('dbo_orders_CT', 5, 'id', 1), ('dbo_orders_CT', 9, 'price', NULL),
('orders', 1, '__$From', NULL), ('orders', 2, '__$To', NULL), ('orders', 3, 'id', 1), ('orders', 7, 'line', 2), ('orders', 4, 'price', NULL), ('keyless', 1, '__$From', NULL), ('keyless', 2, '__$To', NULL), ('keyless', 3, 'x', NULL),
('shop', 1, '__$From', NULL), ('shop', 3, 'id', 1), ('legacy', 1, 'DateFrom', NULL), ('legacy', 2, 'DateTo', NULL), ('legacy', 3, 'id', 1), ('plain', 2, 'b', NULL), ('plain', 1, 'a', 1)) AS v(t, i, c, k)"""
FORMS = f"""c AS ({CATALOG}),
f AS (SELECT TableName, SUM(CASE WHEN ColumnName = '__$start_lsn' THEN 1 ELSE 0 END) AS l, SUM(CASE WHEN ColumnName IN ('__$From', '__$To') THEN 1 ELSE 0 END) AS ft, SUM(CASE WHEN ColumnName = '__$From' THEN 1 ELSE 0 END) AS f,
             SUM(CASE WHEN ColumnName IN ('DateFrom', 'DateTo') THEN 1 ELSE 0 END) AS d, MAX(KeyId) AS k FROM c GROUP BY TableName),
forms AS (SELECT TableName, CASE WHEN TableName = '__$Complete' THEN 'CTL' WHEN TableName = 'lsn_time_mapping' THEN 'XXX' WHEN l = 1 THEN 'CDC' WHEN ft = 2 AND k IS NOT NULL THEN 'LAK' WHEN f = 1 THEN 'PUB' WHEN d = 2 AND k IS NOT NULL THEN 'OLD' ELSE 'NON' END AS Form FROM f),
kept AS (SELECT c.*, Form FROM c JOIN forms USING (TableName) WHERE Form <> 'XXX' AND NOT (Form IN ('CDC', 'LAK', 'PUB') AND ColumnName LIKE '\\_\\_$%' ESCAPE '\\') AND NOT (Form = 'OLD' AND ColumnName IN ('DateFrom', 'DateTo')))"""


@query(f"WITH {FORMS} SELECT TableName, ColumnId, ColumnName, KeyId, Form FROM kept")
def form_classify(spark, sf):
    return metadata.classify_forms(frame(spark, CATALOG), "sales")


@query(f"WITH {FORMS} SELECT TableName, ColumnName, CAST(RANK() OVER (PARTITION BY TableName ORDER BY ColumnId) AS INT) AS ColumnOrdinal, CASE WHEN KeyId IS NOT NULL THEN CAST(RANK() OVER (PARTITION BY TableName ORDER BY COALESCE(KeyId, 128)) AS INT) END AS KeyOrdinal FROM kept")
def ordinal_rank(spark, sf):
    return metadata.ordinals(metadata.classify_forms(frame(spark, CATALOG), "sales")).select("TableName", "ColumnName", "ColumnOrdinal", "KeyOrdinal")


CONSTRAINTS = "SELECT t AS TableName, n AS Name, c AS Kind, o AS ColumnName, CAST(p AS INT) AS Position FROM (VALUES ('a', 'pk_a', 'P', 'x', 1), ('a', 'pk_a', 'P', 'y', 2), ('a', 'uq_a', 'U', 'z', 1), ('b', 'ix_b', 'X', 'u', 1), ('b', 'uq_b', 'U', 'v', 1), ('c', 'ix_1', 'X', 'p', 1), ('c', 'ix_0', 'X', 'q', 1)) AS v(t, n, c, o, p)"


@query(f"WITH c AS ({CONSTRAINTS}), s AS (SELECT *, COUNT(*) OVER (PARTITION BY TableName, Name) AS n FROM c), r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY TableName ORDER BY n, CASE Kind WHEN 'P' THEN 1 WHEN 'U' THEN 2 ELSE 3 END, Name) AS r FROM s) SELECT TableName, Name, ColumnName, Position AS KeyId FROM r WHERE r = 1")
def key_pick(spark, sf):
    return metadata.pick_key(frame(spark, CONSTRAINTS))


CLUSTERED = "SELECT t AS TableName, c AS ColumnName, CAST(ip AS INT) AS IsPrimary, CAST(po AS INT) AS PrimaryOrdinal, CAST(co AS INT) AS ClusteredOrdinal FROM (VALUES ('a', 'x', 1, 1, 2), ('a', 'y', 0, NULL, 1), ('b', 'p', 0, NULL, 1), ('b', 'q', 0, NULL, NULL)) AS v(t, c, ip, po, co)"


@query(f"WITH c AS ({CLUSTERED}) SELECT TableName, ColumnName, CASE WHEN MAX(IsPrimary) OVER (PARTITION BY TableName) = 1 THEN PrimaryOrdinal ELSE ClusteredOrdinal END AS KeyId FROM c")
def key_primary(spark, sf):
    return metadata.primary_or_clustered(frame(spark, CLUSTERED)).select("TableName", "ColumnName", "KeyId")


LIMIT = f"lim AS (SELECT MAX(lsn) AS lsn, MAX(__from) AS __from FROM f_time WHERE __from <= LEAST({T_END}, TIMESTAMP '2024-01-18 06:30:00' - INTERVAL '1' SECOND))"


@query(f"WITH {LIMIT} SELECT * FROM lim")
def hwm_cdc(spark, sf):
    return metadata.cdc_limit(fixture(spark, sf, "f_time"), END, datetime(2024, 1, 18, 6, 30))


@query(f"WITH {LIMIT}, l AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS TableName, MAX(event_id) AS lsn FROM events WHERE event_id <= (SELECT lsn FROM lim) GROUP BY 1) SELECT l.TableName, l.lsn, t.__from FROM l LEFT JOIN f_time AS t ON t.lsn = l.lsn")
def hwm_cdc_tables(spark, sf):
    log = spark.read.parquet(f"{sf}/events.parquet").select(F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("TableName"), F.col("event_id").alias("__start_lsn"))
    times = fixture(spark, sf, "f_time")
    return metadata.cdc_marks(log, times, metadata.cdc_limit(times, END, datetime(2024, 1, 18, 6, 30)))


@query(f"SELECT MAX(__from) AS DMLDate FROM f_lak WHERE __to = {OPEN_SQL} AND __from <= LEAST({T_END}, TIMESTAMP '2024-01-25 00:00:00')")
def hwm_lake(spark, sf):
    return metadata.lake_mark(lake(spark, sf), END, datetime(2024, 1, 25))


@query(f"SELECT {_utc('MAX(DateFrom)')} AS DMLDate FROM f_old WHERE DateFrom <= {TC_END}")
def hwm_old(spark, sf):
    return metadata.old_mark(fixture(spark, sf, "f_old"), C_END)


# ---- X: matching ----

SOURCES = "SELECT t AS SourceTable, f AS SourceForm FROM (VALUES ('orders', 'CDC'), ('orders_202401', 'CDC'), ('orders202312', 'CDC'), ('ordersx202402', 'CDC'), ('orders_209913', 'CDC'), ('items', 'NON'), ('parts_202005', 'CDC')) AS v(t, f)"
TARGETS = "SELECT t AS TargetTable, f AS TargetForm FROM (VALUES ('orders', 'LAK'), ('items', 'LAK'), ('parts', 'LAK'), ('parts_', 'LAK')) AS v(t, f)"
WANTED = "SELECT s AS SourceForm, t AS TargetForm FROM (VALUES ('CDC', 'LAK')) AS v(s, t)"
MATCHED = f"""s AS ({SOURCES}), t AS ({TARGETS}), f AS ({WANTED}),
m AS (SELECT s.SourceForm, t.TargetForm, SourceTable, TargetTable FROM s JOIN t ON SourceTable = TargetTable OR regexp_full_match(SourceTable, TargetTable || '.20[0-2][0-9][0-1][0-9]') OR regexp_full_match(SourceTable, TargetTable || '20[0-2][0-9][0-1][0-9]') JOIN f ON f.SourceForm = s.SourceForm AND f.TargetForm = t.TargetForm)"""


@query(f"WITH {MATCHED} SELECT SourceForm, TargetForm, SourceTable, TargetTable FROM m")
def table_match(spark, sf):
    return matching.match_tables(frame(spark, SOURCES), frame(spark, TARGETS), frame(spark, WANTED)).drop("Source")


@query(f"WITH {MATCHED}, r AS (SELECT SourceTable, TargetTable, RIGHT(REPLACE(SourceTable, TargetTable, ''), 4) AS x FROM m) SELECT SourceTable, TargetTable, CAST(CASE WHEN x = '' THEN '0' ELSE x END AS SMALLINT) AS Source FROM r")
def source_number(spark, sf):
    return matching.match_tables(frame(spark, SOURCES), frame(spark, TARGETS), frame(spark, WANTED)).select("SourceTable", "TargetTable", "Source")


SIDE_S = "SELECT t AS TableName, c AS ColumnName, CAST(o AS INT) AS ColumnOrdinal FROM (VALUES ('a', 'x', 1), ('a', 'y', 2), ('a', 'z', 3), ('a', 'new', 4), ('b', 'k1', 1), ('b', 'k2', 2)) AS v(t, c, o)"
SIDE_T = "SELECT t AS TableName, c AS ColumnName, CAST(o AS INT) AS ColumnOrdinal, CAST(k AS INT) AS KeyOrdinal FROM (VALUES ('a', 'x', 1, NULL), ('a', 'y', 2, 1), ('a', 'z', 3, NULL), ('a', 'old', 4, NULL), ('b', 'k2', 1, 2), ('b', 'k1', 2, 1)) AS v(t, c, o, k)"
LISTS = f"""s AS ({SIDE_S}), t AS ({SIDE_T}),
c AS (SELECT t.TableName, t.ColumnName, RANK() OVER (PARTITION BY t.TableName ORDER BY COALESCE(KeyOrdinal, 999), t.ColumnOrdinal) AS p, KeyOrdinal IS NOT NULL AS key FROM s JOIN t ON s.TableName = t.TableName AND s.ColumnName = t.ColumnName)"""


@query(f"""WITH {LISTS} SELECT TableName, string_agg(ColumnName, ', ' ORDER BY p) AS ColumnNames, string_agg('a.' || ColumnName, ', ' ORDER BY p) AS ColumnPrefixes,
string_agg(ColumnName, ', ' ORDER BY p) FILTER (WHERE key) AS KeyNames, string_agg('a.' || ColumnName, ', ' ORDER BY p) FILTER (WHERE key) AS KeyPrefixes,
string_agg('b.' || ColumnName || ' = a.' || ColumnName, ' AND ' ORDER BY p) FILTER (WHERE key) AS Conditions,
COALESCE(string_agg('b.' || ColumnName || ' = a.' || ColumnName, ', ' ORDER BY p) FILTER (WHERE NOT key), string_agg('b.' || ColumnName || ' = a.' || ColumnName, ', ' ORDER BY p) FILTER (WHERE key)) AS Assignments FROM c GROUP BY TableName""")
def column_lists(spark, sf):
    return matching.column_lists(matching.match_columns(frame(spark, SIDE_S), frame(spark, SIDE_T)))


WINDOWS = "SELECT CAST(MIN(ts) AS TIMESTAMP_NTZ) AS FromDate, CAST(CASE WHEN user_id % 3 = 0 THEN MIN(ts) ELSE MAX(ts) END AS TIMESTAMP_NTZ) AS ToDate FROM events GROUP BY user_id"


@query(f"WITH w AS ({WINDOWS}) SELECT MIN(CASE WHEN FromDate <> ToDate THEN FromDate END) AS MinFromDate, MAX(FromDate) AS MaxFromDate, MAX(ToDate) AS MaxToDate FROM w")
def batch_dates(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").groupBy("user_id").agg(F.min("ts").alias("FromDate"), F.max("ts").alias("b"))
    return matching.batch_dates(e.select("FromDate", F.when(F.col("user_id") % 3 == 0, F.col("FromDate")).otherwise(F.col("b")).alias("ToDate")))


# ---- C, V1, V2: control ----

NTZ = lambda t: "CAST(NULL AS TIMESTAMP_NTZ)" if t is None else f"CAST('{t}' AS TIMESTAMP_NTZ)"
MARKS = lambda a, b, c: f"SELECT {NTZ(a)} AS CompleteDate, {NTZ(b)} AS LoadedDate, {NTZ(c)} AS RetentionDate"
OLD_MARKS, NEW_MARKS = MARKS("2024-01-01 00:00:00", "2024-01-02 00:00:00", None), MARKS("2024-02-01 00:00:00", None, None)


@query(f"WITH o AS ({OLD_MARKS}), n AS ({NEW_MARKS}) SELECT COALESCE(n.CompleteDate, o.CompleteDate, TIMESTAMP '1900-01-01') AS CompleteDate, COALESCE(n.LoadedDate, o.LoadedDate, TIMESTAMP '1900-01-01') AS LoadedDate, COALESCE(n.RetentionDate, o.RetentionDate, TIMESTAMP '1900-01-01') AS RetentionDate FROM o FULL JOIN n ON 1 = 1")
def complete_merge(spark, sf):
    return control.merge_complete(frame(spark, OLD_MARKS), frame(spark, NEW_MARKS))


EVENTS = "SELECT event_id AS event, CONCAT('b', CAST(user_id AS VARCHAR(20))) AS Batch, ts AS EventTime, CASE event_type WHEN 'error' THEN 'Failure' WHEN 'signup' THEN 'Success' ELSE 'Running' END AS Outcome, CASE WHEN event_type = 'error' THEN 'broken' END AS ErrorMessage, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS BIGINT) END AS InsertCount FROM events"


@query(f"""WITH e AS ({EVENTS}) SELECT Batch, arg_min(EventTime, event) AS StartTime, arg_max(EventTime, event) FILTER (WHERE Outcome IN ('Success', 'Failure', 'Pass')) AS EndTime,
(SELECT x.ErrorMessage FROM e AS x WHERE x.event = MAX(e.event)) AS ErrorMessage, arg_max(Outcome, event) AS Outcome, arg_max(InsertCount, event) FILTER (WHERE InsertCount IS NOT NULL) AS InsertCount FROM e GROUP BY Batch""")
def log_upsert(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    rows = e.select(
        F.col("event_id").alias("event"), F.concat(F.lit("b"), F.col("user_id").cast("string")).alias("Batch"), F.col("ts").alias("EventTime"),
        F.when(F.col("event_type") == "error", "Failure").when(F.col("event_type") == "signup", "Success").otherwise("Running").alias("Outcome"),
        F.when(F.col("event_type") == "error", "broken").alias("ErrorMessage"), F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("InsertCount"),
    )
    return control.merge_log(rows, ["Batch"])


TEMPLATES = "SELECT CAST(i AS INT) AS TemplateId, t AS Task, a AS Action, s AS SourceForm, f AS TargetForm, CAST(d AS TIMESTAMP_NTZ) AS CreatedDate, 'Y' AS Enabled FROM (VALUES (1, 'CDC-LAK', 'Load', 'CDC', 'LAK', '2024-01-01 00:00:00'), (2, 'CDC-LAK', 'Load', 'CDC', 'LAK', '2024-02-01 00:00:00'), (3, 'CDC-LAK', 'Load', 'CDC', 'LAK', '2024-03-01 00:00:00'), (4, 'LAK-PUB', 'Load', 'LAK', 'PUB', '2024-01-05 00:00:00')) AS v(i, t, a, s, f, d)"


@query(f"WITH t AS ({TEMPLATES}), w AS (SELECT *, MAX(TemplateId) OVER p = TemplateId AS latest, MIN(CreatedDate) OVER p AS first FROM t WINDOW p AS (PARTITION BY Task, Action, SourceForm, TargetForm)) SELECT TemplateId, Task, Action, SourceForm, TargetForm, CASE WHEN latest THEN first ELSE CreatedDate END AS CreatedDate, CASE WHEN latest THEN 'Y' ELSE 'N' END AS Enabled FROM w")
def template_activate(spark, sf):
    return control.activate(frame(spark, TEMPLATES))


SUMMARY = """SELECT BatchDate, Batch, Task, MIN(StartTime) AS FirstQueryStart, COUNT(*) AS Considered, CAST(SUM(CASE Outcome WHEN 'Pass' THEN 1 ELSE 0 END) AS BIGINT) AS Passed, CAST(SUM(CASE Outcome WHEN 'Success' THEN 1 ELSE 0 END) AS BIGINT) AS Processed,
CAST(SUM(CASE Outcome WHEN 'Failure' THEN 1 ELSE 0 END) AS BIGINT) AS Failed, CAST(SUM(CASE Outcome WHEN 'Running' THEN 1 ELSE 0 END) AS BIGINT) AS Running, CAST(SUM(InsertCount) AS BIGINT) AS Inserted, CAST(SUM(UpdateCount) AS BIGINT) AS Updated, CAST(SUM(DeleteCount) AS BIGINT) AS Deleted,
MAX(CASE Outcome WHEN 'Running' THEN ObjectName END) AS InProgress, DatabaseName AS Target, CASE SchemaName WHEN 'dbo' THEN DatabaseName ELSE SchemaName END AS Subject,
CAST(epoch_us(MAX(EndTime)) // 1000 - epoch_us(MIN(StartTime)) // 1000 AS BIGINT) AS Elapsed FROM f_log GROUP BY BatchDate, Batch, Task, DatabaseName, SchemaName"""


@query(SUMMARY)
def run_summary(spark, sf):
    return control.run_summary(fixture(spark, sf, "f_log"))


@query(f"WITH s AS ({SUMMARY}) SELECT * FROM s WHERE BatchDate IN (SELECT DISTINCT BatchDate FROM f_log ORDER BY BatchDate DESC LIMIT 20) ORDER BY FirstQueryStart DESC, Batch, Task, Target, Subject LIMIT 20")
def run_latest(spark, sf):
    return control.run_latest(fixture(spark, sf, "f_log"))


# ---- B: maintenance ----


@query(f"SELECT k, v, DateFrom, CASE WHEN DateTo > {TC_BEGIN} AND DateTo < TIMESTAMP '9999-01-01' THEN {OPEN_SQL} ELSE DateTo END AS DateTo FROM f_old WHERE DateFrom <= {TC_BEGIN}", "DateTo")
def rollback(spark, sf):
    return maintenance.rollback(fixture(spark, sf, "f_old"), C_BEGIN).result


@query(f"SELECT CAST(SUM(CASE WHEN DateFrom > {TC_BEGIN} THEN 1 ELSE 0 END) AS BIGINT) AS deleted, CAST(SUM(CASE WHEN DateFrom <= {TC_BEGIN} AND DateTo > {TC_BEGIN} AND DateTo < TIMESTAMP '9999-01-01' THEN 1 ELSE 0 END) AS BIGINT) AS updated FROM f_old")
def rollback_counts(spark, sf):
    return maintenance.rollback_counts(fixture(spark, sf, "f_old"), C_BEGIN)


@query("SELECT * FROM f_lak WHERE __to >= TIMESTAMP '2024-01-12 00:00:00'", TO)
def retention(spark, sf):
    day = maintenance.retention_date(END, 7, date(2024, 1, 15))
    return maintenance.retain(lake(spark, sf), day)


UNORDERED = "h AS (SELECT __from, __to, CASE WHEN v > 50 THEN __load + INTERVAL '3' HOUR ELSE __load END AS __load, __action, __source, k, v FROM f_lak)"


def _unordered(spark, sf) -> DataFrame:
    return lake(spark, sf).withColumn(LOAD, F.when(F.col("v") > 50, F.col(LOAD) + F.expr("INTERVAL 3 HOURS")).otherwise(F.col(LOAD)))


@query(f"WITH {UNORDERED}, n AS (SELECT *, LEAD(__from) OVER (PARTITION BY k ORDER BY __load, __from) AS next_from FROM h) SELECT __from, __to, __load, __action, __source, k, v, next_from FROM n WHERE next_from <= __from", TO)
def sequence_check(spark, sf):
    return maintenance.out_of_sequence(_unordered(spark, sf).withColumn("o", F.struct(LOAD, FROM)), ["k"], "o").drop("o")


@query(f"""WITH {UNORDERED}, n AS (SELECT *, LAG(__from) OVER w AS lf, LAG(__to) OVER w AS lt, LEAD(__from) OVER w AS nf, LEAD(__to) OVER w AS nt FROM h WINDOW w AS (PARTITION BY k ORDER BY __load, __from))
SELECT CASE WHEN lf >= __from THEN lf WHEN nf <= __from THEN nf ELSE __from END AS __from, CASE WHEN lf >= __from THEN lt WHEN nf <= __from THEN nt ELSE __to END AS __to, __load, __action, __source, k, v FROM n""", TO)
def sequence_fix(spark, sf):
    return maintenance.fix_sequence(_unordered(spark, sf).withColumn("o", F.struct(LOAD, FROM)), ["k"], "o").drop("o")


# ---- S, P: schemas and layout ----

PROPS_S = "SELECT t AS TableName, c AS ColumnName, y AS ColumnType, CAST(l AS INT) AS ColumnLength FROM (VALUES ('a', 'x', 'int', 4), ('a', 'y', 'varchar', 20), ('b', 'p', 'int', 4), ('c', 'q', 'int', NULL), ('c', 'r', 'int', 4)) AS v(t, c, y, l)"
PROPS_T = "SELECT t AS TableName, c AS ColumnName, y AS ColumnType, CAST(l AS INT) AS ColumnLength FROM (VALUES ('a', 'x', 'int', 4), ('a', 'y', 'varchar', 10), ('a', 'gone', 'int', 4), ('c', 'q', 'int', 4), ('c', 'r', 'int', 4)) AS v(t, c, y, l)"


@query(f"""WITH s AS ({PROPS_S}), t AS ({PROPS_T}), j AS (SELECT s.*, CASE WHEN t.ColumnName IS NULL THEN 'A' WHEN s.ColumnType <> t.ColumnType OR s.ColumnLength <> t.ColumnLength THEN 'M' ELSE '=' END AS ColumnStatus FROM s LEFT JOIN t ON s.TableName = t.TableName AND s.ColumnName = t.ColumnName)
SELECT *, CASE WHEN SUM(CASE WHEN ColumnStatus <> '=' THEN 1 ELSE 0 END) OVER (PARTITION BY TableName) = 0 THEN '=' WHEN SUM(CASE WHEN ColumnStatus <> 'A' THEN 1 ELSE 0 END) OVER (PARTITION BY TableName) = 0 THEN 'A' ELSE 'M' END AS TableStatus FROM j""")
def schema_diff(spark, sf):
    return schema_sync.schema_diff(frame(spark, PROPS_S), frame(spark, PROPS_T), ("ColumnType", "ColumnLength"))


VALUES = "SELECT CAST(d AS TIMESTAMP_NTZ) AS value FROM (VALUES ('2024-01-01 00:00:00'), ('2024-02-01 00:00:00'), ('2024-04-01 00:00:00'), ('2024-04-15 00:00:00'), ('9999-12-31 00:00:00')) AS v(d)"


@query(f"""WITH v AS ({VALUES}), i AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-07-01', INTERVAL 1 MONTH)) AS Boundary),
u AS (SELECT Boundary, 'Insert' AS a FROM i UNION ALL SELECT {OPEN_SQL}, 'Insert' UNION ALL SELECT TIMESTAMP '9999-12-31 23:59:59.999', 'Insert' UNION ALL SELECT value, 'Merge' FROM v)
SELECT Boundary, MAX(a) AS Action FROM u GROUP BY Boundary HAVING COUNT(*) <> 2""", "Boundary")
def partition_boundaries(spark, sf):
    return layout.boundaries(frame(spark, VALUES), "M", high=datetime(2024, 6, 15), gap_fill=True, trim=True)


@query(f"WITH v AS ({VALUES}) SELECT CASE WHEN COUNT(*) <= 1 THEN 'M' WHEN (MAX(CAST(value AS DATE)) - MIN(CAST(value AS DATE))) // (COUNT(*) - 1) > 20 THEN 'M' ELSE 'D' END AS grain FROM v WHERE value < {OPEN_SQL}")
def partition_grain(spark, sf):
    return layout.grain(frame(spark, VALUES))


PARTITIONS = "SELECT 'orders' AS TableName, 'CI' AS IndexName, CAST(p AS INT) AS PartitionNumber, c AS Compression FROM (VALUES (1, 'ROW'), (2, 'ROW'), (3, 'PAGE'), (4, 'PAGE'), (5, 'PAGE'), (6, 'ROW'), (7, 'ROW')) AS v(p, c)"


@query(f"WITH p AS ({PARTITIONS}), w AS (SELECT *, CASE WHEN PartitionNumber = 1 OR PartitionNumber > MAX(PartitionNumber) OVER () - 4 THEN 'ROW' ELSE 'PAGE' END AS wanted FROM p) SELECT *, wanted <> Compression AS rebuild FROM w")
def compression_plan(spark, sf):
    return layout.compression(frame(spark, PARTITIONS))


BLUE = "SELECT * FROM (VALUES ('orders', 'CI_orders(A)', 'CLUSTERED', TRUE, 'id', 1), ('orders', 'CI_orders(A)', 'CLUSTERED', TRUE, '__$Source', 2), ('orders', 'CI_orders(A)', 'CLUSTERED', TRUE, '__$To', 3), ('orders', 'NI_orders_FD(A)', 'NONCLUSTERED', FALSE, '__$From', 1), ('orders', 'NI_orders_TD(A)', 'NONCLUSTERED', FALSE, '__$To', 1), ('orders', 'NI_orders_LD(A)', 'NONCLUSTERED', FALSE, '__$Load', 1)) AS v(TableName, IndexName, IndexType, UniqueIndex, ColumnName, ColumnOrder)"
HAVE = "SELECT * FROM (VALUES ('orders', 'CI_orders(A)', 'CLUSTERED', TRUE, 'id', 1), ('orders', 'CI_orders(A)', 'CLUSTERED', TRUE, '__$Source', 2), ('orders', 'NI_orders_FD(A)', 'NONCLUSTERED', FALSE, '__$From', 1), ('orders', 'NI_old', 'NONCLUSTERED', FALSE, 'price', 1)) AS v(TableName, IndexName, IndexType, UniqueIndex, ColumnName, ColumnOrder)"


@query(BLUE)
def index_blueprint(spark, sf):
    return layout.blueprint(spark, "orders", "LAK", ["id"], "__$To")


@query(f"""WITH a AS ({HAVE}), b AS ({BLUE}), u AS (SELECT 'DROP' AS s, TableName, IndexName, IndexType, UniqueIndex, string_agg(ColumnName, ',' ORDER BY ColumnOrder) AS Columns FROM a GROUP BY 1, 2, 3, 4, 5
UNION ALL SELECT 'CREATE', TableName, IndexName, IndexType, UniqueIndex, string_agg(ColumnName, ',' ORDER BY ColumnOrder) FROM b GROUP BY 1, 2, 3, 4, 5)
SELECT TableName, IndexName, IndexType, UniqueIndex, Columns, MIN(s) AS Action FROM u GROUP BY 1, 2, 3, 4, 5 HAVING COUNT(*) <> 2""")
def index_changes(spark, sf):
    return layout.index_changes(layout.blueprint(spark, "orders", "LAK", ["id"], "__$To"), frame(spark, HAVE))


STATS = "SELECT t AS TableName, CAST(p AS BIGINT) AS Pages, CAST(f AS DOUBLE) AS Fragmentation FROM (VALUES ('a', 5000, 45.0), ('b', 5000, 30.0), ('c', 5000, 5.0), ('d', 5000, 4.9), ('e', 1000, 90.0)) AS v(t, p, f)"


@query(f"WITH s AS ({STATS}) SELECT *, CASE WHEN Fragmentation >= 30 THEN 'Rebuild' WHEN Fragmentation >= 5 THEN 'Reorganize' ELSE 'Pass' END AS Action FROM s WHERE Pages > 1000")
def defrag_plan(spark, sf):
    return layout.defragment(frame(spark, STATS))


