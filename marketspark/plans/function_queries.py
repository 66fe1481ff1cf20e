"""Queries that exercise the column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays, dates, serving, text
from ..sources import views
from .registry import TICKS, query, with_ctes


@query("f1_integer_text", """
SELECT s_suppkey, CAST(trunc(abs(s_acctbal)) AS BIGINT) AS parsed, CAST(0 AS BIGINT) AS bad FROM supplier""")
def f1(spark, sf):
    shown = F.concat(F.when(F.col("s_acctbal") < 0, "-").otherwise("+"), F.format_number(F.abs("s_acctbal"), 2), F.lit("원"))
    return views.table(spark, sf, "supplier").select(
        "s_suppkey", text.parse_int(shown).alias("parsed"), text.parse_int(F.col("s_name")).alias("bad"))


@query("f2_percent_text", """
SELECT s_suppkey, s_acctbal AS parsed, CAST(0 AS DOUBLE) AS bad FROM supplier""")
def f2(spark, sf):
    shown = F.concat(F.when(F.col("s_acctbal") > 0, "+").otherwise(""), F.format_number("s_acctbal", 2), F.lit("%"))
    return views.table(spark, sf, "supplier").select(
        "s_suppkey", text.parse_float(shown).alias("parsed"), text.parse_float(F.col("s_name")).alias("bad"))


@query("f3_change_code", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '상승' WHEN 'F' THEN '하락' WHEN 'P' THEN '보합' ELSE o_orderstatus END AS change FROM orders""")
def f3(spark, sf):
    code = F.col("o_orderstatus")
    sent = F.when(code == "O", "RISE").when(code == "F", "FALL").when(code == "P", "EVEN").otherwise(code)
    return views.table(spark, sf, "orders").select("o_orderkey", text.change_text(sent).alias("change"))


@query("f4_url_parameter", r"""
SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page, regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref FROM pages""")
def f4(spark, sf):
    url = F.col("url")
    return views.table(spark, sf, "pages").select(
        "page_id", text.url_parameter(url, "page").alias("page"), text.url_parameter(url, "ref").alias("ref"))


@query("f5_prefix_strip", """
SELECT l_suppkey, count(*) AS n, lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS code FROM lineitem GROUP BY 1, 3""")
def f5(spark, sf):
    sent = F.concat(F.lit("A"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"))
    return views.table(spark, sf, "lineitem").groupBy("l_suppkey", text.strip_prefix(sent).alias("code")).agg(
        F.count("*").alias("n"))


@query("f6_market_and_quote_codes", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '0' ELSE '1' END AS market_number,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) || '.KS' ELSE c_name END AS quote_symbol FROM customer""")
def f6(spark, sf):
    rows = views.table(spark, sf, "customer")
    market = F.when(F.col("c_mktsegment") == "BUILDING", "kospi").otherwise("kosdaq")
    code = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.col("c_name"))
    return rows.select("c_custkey", text.market_number(market).alias("market_number"), text.quote_symbol(code).alias("quote_symbol"))


@query("f7_iso_format", with_ctes(TICKS, body="""
SELECT event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM ticks"""))
def f7(spark, sf):
    return views.ticks(spark, sf).select("event_id", dates.iso_utc(F.col("event_time")).alias("iso"))


@query("f10_period_text", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d, strftime(o_orderdate, '%Y%m') AS m,
       strftime(o_orderdate, '%Y') || 'Q' || quarter(o_orderdate) AS q, strftime(o_orderdate, '%Y') AS a,
       CAST(CAST(o_orderdate AS DATE) - 372 AS DATE) AS window_start,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q_start FROM orders""")
def f10(spark, sf):
    day = F.col("o_orderdate").cast("date")
    texts = {c.lower(): dates.period_text(day, F.lit(c)) for c in "DMQA"}
    return views.table(spark, sf, "orders").select(
        "o_orderkey", *[e.alias(n) for n, e in texts.items()], dates.months_back(day, 12).alias("window_start"),
        dates.period_start(F.lit("Q"), texts["q"]).alias("q_start"))


@query("f11_fetch_period", """
SELECT p_partkey, CASE WHEN p_size > 20 OR p_size = 20 THEN '2y' WHEN p_size IN (1, 2) THEN '3mo' WHEN p_size = 5 THEN '6mo' ELSE '1y' END AS period FROM part""")
def f11(spark, sf):
    return views.table(spark, sf, "part").select("p_partkey", dates.fetch_period(F.col("p_size")).alias("period"))


_SOFT = """vec AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
soft AS (SELECT vec_id, v, list_transform(v, lambda x: exp(x - list_max(v))) AS e FROM vec),
probs AS (SELECT vec_id, v, list_transform(e, lambda x: x / list_sum(e)) AS p FROM soft)"""
_SOFT3 = """cells AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
vec AS (SELECT vec_id, list(s ORDER BY c) AS v FROM (SELECT vec_id, i % 3 AS c, sum(CAST(x AS DOUBLE)) AS s FROM cells GROUP BY 1, 2) GROUP BY 1),
soft AS (SELECT vec_id, v, list_transform(v, lambda x: exp(x - list_max(v))) AS e FROM vec),
probs AS (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM soft)"""


def vectors(spark, sf):
    return views.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def class_scores(spark, sf):
    """Three scores of every vector: the sums of its cells 0, 3, ..., 1, 4, ... and 2, 5, ..."""
    every_third = lambda c: arrays.array_total(F.filter("v", lambda x, i: i % 3 == c))
    return vectors(spark, sf).withColumn("v", F.array(*[every_third(c) for c in range(3)]))


@query("f15_softmax", with_ctes(_SOFT, body="""
SELECT vec_id, round(p[1], 8) AS p1, round(p[len(p)], 8) AS p_last, round(list_max(p), 8) AS p_max, round(list_sum(p), 6) AS total FROM probs"""))
def f15(spark, sf):
    rows = vectors(spark, sf).withColumn("p", arrays.softmax(F.col("v")))
    return rows.select(
        "vec_id", F.round(F.col("p")[0], 8).alias("p1"), F.round(F.element_at("p", -1), 8).alias("p_last"),
        F.round(F.array_max("p"), 8).alias("p_max"), F.round(arrays.array_total(F.col("p")), 6).alias("total"))


@query("f16_positional_encoding", """
SELECT p_partkey, CAST(d AS INTEGER) AS dim,
       round(CASE WHEN d % 2 = 0 THEN sin(p_size / power(10000, d / CAST(8 AS DOUBLE))) ELSE cos(p_size / power(10000, (d - 1) / CAST(8 AS DOUBLE))) END, 8) + 0 AS value
FROM part, range(8) r(d)""")
def f16(spark, sf):
    code = arrays.positional_encoding(F.col("p_size").cast("double"), 8)
    return views.table(spark, sf, "part").select("p_partkey", F.posexplode(code).alias("dim", "value")).withColumn(
        "value", F.round("value", 8))


@query("f17_probability_map", with_ctes(_SOFT3, body="""
SELECT vec_id, round(p[1], 4) AS sell, round(p[2], 4) AS hold, round(p[3], 4) AS buy FROM probs"""))
def f17(spark, sf):
    rows = class_scores(spark, sf).select("vec_id", serving.probability_map(arrays.softmax(F.col("v")), [-1, 0, 1]).alias("m"))
    return rows.select("vec_id", *[F.col("m")[k].alias(k.lower()) for k in ("SELL", "HOLD", "BUY")])


@query("f18_argmax_signal", with_ctes(_SOFT3, body="""
SELECT vec_id, CASE list_position(p, list_max(p)) WHEN 1 THEN 'SELL' WHEN 2 THEN 'HOLD' ELSE 'BUY' END AS signal FROM probs"""))
def f18(spark, sf):
    rows = class_scores(spark, sf)
    return rows.select("vec_id", text.signal_of(arrays.argmax_index(F.col("v")) - 1).alias("signal"))


@query("f19_prediction_responses", with_ctes(_SOFT3, body="""
SELECT vec_id,
  CASE vec_id % 4 WHEN 3 THEN 'HOLD' WHEN 2 THEN 'SELL' ELSE 'BUY' END AS signal,
  CASE vec_id % 4 WHEN 3 THEN 0 ELSE round(p[1], 6) END AS buy,
  CASE vec_id % 4 WHEN 3 THEN 0 ELSE round(p[2], 6) END AS sell,
  CASE vec_id % 4 WHEN 3 THEN 1 ELSE round(p[3], 6) END AS hold FROM probs"""))
def f19(spark, sf):
    p = F.transform(arrays.softmax(F.col("v")), lambda x: F.round(x, 6).cast("string"))
    rows = class_scores(spark, sf).withColumn("p", p)
    named = F.format_string('"probabilities":{"BUY":%s,"-1":%s,"0":%s}', F.col("p")[0], F.col("p")[1], F.col("p")[2])
    listed = F.concat(F.lit('"prediction_scores":['), F.array_join("p", ","), F.lit("]"))
    which = F.col("vec_id") % 4
    body = (
        F.when(which == 0, F.concat(F.lit('[{"predicted_label":"BUY",'), named, F.lit("}]")))
        .when(which == 1, F.concat(F.lit('{"prediction":"1",'), listed, F.lit("}")))
        .when(which == 2, F.concat(F.lit('{"predicted_label":-1,'), named, F.lit("}")))
        .otherwise(F.lit('"unreadable"'))
    )
    parsed = rows.select("vec_id", body.alias("response")).select("vec_id", serving.parse_response(F.col("response")).alias("r"))
    return parsed.select("vec_id", "r.signal", *[F.col(f"r.probabilities.{k}").alias(k.lower()) for k in ("BUY", "SELL", "HOLD")])


@query("j9_code_table", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'SELL' WHEN 1 THEN 'HOLD' WHEN 2 THEN 'BUY' ELSE 'HOLD' END AS signal,
       CASE WHEN p_type = 'ECONOMY' THEN 2 WHEN p_type = 'STANDARD' THEN 1 ELSE 0 END AS level FROM part""")
def j9(spark, sf):
    kind = F.when(F.col("p_type") == "ECONOMY", "critical").when(F.col("p_type") == "STANDARD", "Warning").otherwise(F.col("p_type"))
    return views.table(spark, sf, "part").select(
        "p_partkey", text.signal_of(F.col("p_size") % 4 - 1).alias("signal"), text.severity_level(kind).alias("level"))
