"""Query registry: name -> Spark callable and, where one exists, oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# DuckDB forms of the canonical views.
TICKS = """ticks AS (
  SELECT event_id, event_type AS symbol, upper(event_type) AS name, 'SIM' AS market, ts AS event_time,
         CAST(50 + k * 0.5 AS DOUBLE) AS price, CAST(50 + k * 0.5 AS DOUBLE) AS open,
         CAST(51 + k * 0.5 AS DOUBLE) AS high, CAST(48 + k * 0.5 AS DOUBLE) AS low,
         CAST(50 + k * 0.5 AS DOUBLE) AS "close",
         CAST(floor(value * 100) AS BIGINT) AS volume,
         CAST(k - 50 AS DOUBLE) / CAST(10 AS DOUBLE) AS change_pct
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

BARS = """bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS "date",
         arg_min(l_extendedprice, ord) AS open, max(l_extendedprice) AS high,
         min(l_extendedprice) AS low, arg_max(l_extendedprice, ord) AS "close",
         CAST(sum(l_quantity) AS BIGINT) AS volume, count(*) AS n
  FROM (SELECT *, {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_extendedprice} AS ord FROM lineitem)
  GROUP BY 1, 2)"""

SYMBOLS = """symbols AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name, r_name AS market
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

MACRO = """macro AS (
  SELECT o_orderpriority AS stat_code, 'M' AS cycle, strftime(o_orderdate, '%Y%m') AS "time",
         round(avg(o_totalprice), 4) AS value FROM orders GROUP BY 1, 3)"""

TRADES = """trades AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
         CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
         l_quantity AS qty, l_extendedprice AS price, CAST(l_shipdate AS DATE) AS "date",
         l_linestatus AS broker, CAST(l_orderkey AS VARCHAR) AS order_id FROM lineitem)"""
