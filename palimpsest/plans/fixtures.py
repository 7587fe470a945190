"""Input rows for the registered queries, in the forms that the operators take, from the driver's tables.

Each is SQL that Spark and DuckDB read alike; times are TIMESTAMP without a zone in both.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

FAR = "CAST('9999-12-31 00:00:00' AS TIMESTAMP_NTZ)"
HOUR, DAY = ("CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ)", "CAST(date_trunc('day', ts) AS TIMESTAMP_NTZ)")

SQL = {
    "f_old_rows": "SELECT o_orderkey AS k, o_custkey AS a, o_totalprice AS p, CAST(0 AS SMALLINT) AS __source, CASE WHEN o_orderkey % 13 = 0 THEN 'D' WHEN o_orderkey % 3 = 0 THEN 'U' ELSE 'X' END AS __action FROM orders WHERE o_orderkey % 7 <> 0",
    "f_new_rows": "SELECT o_orderkey AS k, o_custkey AS a, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS p, CAST(0 AS SMALLINT) AS __source FROM orders WHERE o_orderkey % 11 <> 0",
    "f_cdc": "SELECT user_id AS k, value AS v, event_id AS __start_lsn, event_id AS __seqval, CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS __operation FROM events",
    "f_time": f"SELECT event_id AS lsn, {HOUR} AS __from, ts AS tran_end_time FROM events",
    "f_old": f"SELECT user_id AS k, value AS v, ts + INTERVAL '180' DAY AS DateFrom, COALESCE(LEAD(ts + INTERVAL '180' DAY) OVER (PARTITION BY user_id ORDER BY event_id), CASE WHEN event_type = 'error' THEN ts + INTERVAL '181' DAY ELSE {FAR} END) AS DateTo FROM events",
    "f_scn": f"SELECT {DAY} AS scn_dt, MIN(event_id) AS min_scn, MAX(event_id) AS max_scn FROM events GROUP BY 1",
    "f_log": f"SELECT {DAY} AS BatchDate, CAST(CAST({DAY} AS DATE) AS VARCHAR(10)) AS Batch, event_type AS Task, CASE WHEN user_id % 2 = 0 THEN 'dbo' ELSE 'sales' END AS SchemaName, 'lake' AS DatabaseName, CONCAT('t', CAST(user_id AS VARCHAR(20))) AS ObjectName, CASE event_id % 4 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Success' WHEN 2 THEN 'Failure' ELSE 'Running' END AS Outcome, ts AS StartTime, ts + INTERVAL '1' MINUTE AS EndTime, CAST(event_id % 10 AS INT) AS InsertCount, CAST(event_id % 3 AS INT) AS UpdateCount, CAST(event_id % 2 AS INT) AS DeleteCount FROM events",
}

#: A history: the change log of `events`, one version for each key and hour.
LAKE = f"""
a AS (SELECT c.*, t.__from, CASE __operation WHEN 1 THEN 'D' WHEN 2 THEN 'I' ELSE 'U' END AS act
      FROM f_cdc AS c JOIN f_time AS t ON t.lsn = c.__start_lsn WHERE __operation IN (1, 2, 4)),
m AS (SELECT *, MAX(__start_lsn) OVER (PARTITION BY k, __from) AS ml, MAX(__seqval) OVER (PARTITION BY k, __from) AS ms,
             FIRST_VALUE(act) OVER (PARTITION BY k, __from ORDER BY __seqval) AS fa FROM a),
f_lak AS (SELECT __from, LEAD(__from, 1, {FAR}) OVER (PARTITION BY k ORDER BY __from) AS __to, __from AS __load,
                 CASE WHEN act = 'D' THEN 'D' WHEN fa = 'I' THEN 'I' ELSE 'U' END AS __action, CAST(0 AS SMALLINT) AS __source, k, v
          FROM m WHERE __seqval = ms AND __start_lsn = ml)"""


def duck(text: str) -> str:
    """The same SQL for DuckDB, which calls the type TIMESTAMP."""
    return text.replace("TIMESTAMP_NTZ", "TIMESTAMP")


def with_fixtures(query: str) -> str:
    """A DuckDB query with the fixtures that it names, directly or through others, as common table expressions."""
    lake = bool(re.search(r"\bf_lak\b", query))
    text = query + (LAKE if lake else "")
    parts = [f"{n} AS ({s})" for n, s in SQL.items() if re.search(rf"\b{n}\b", text)] + ([LAKE.strip()] if lake else [])
    if not parts:
        return duck(query)
    body = query.strip()
    if body.upper().startswith("WITH "):
        return duck(f"WITH {', '.join(parts)}, {body[5:]}")
    return duck(f"WITH {', '.join(parts)} {body}")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame; its tables are read by their paths, and no view is left behind."""
    text = SQL[name]
    for table in ("orders", "events"):
        text = re.sub(rf"\bFROM {table}\b", f"FROM parquet.`{os.path.join(sf_dir, table)}.parquet`", text)
    return spark.sql(text)


def frame(spark: SparkSession, sql: str) -> DataFrame:
    """Literal rows: SQL over VALUES."""
    return spark.sql(sql)
