"""Queries on landed files; pages stand for what was fetched, orders for sessions whose documents were asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources import landed

_id = "concat('CRE-9-', CAST(page_id AS varchar(20)), CASE WHEN page_id % 3 = 0 THEN '_EN' ELSE '' END)"
_doc = "concat('CRE-9-', CAST(page_id AS varchar(20)), '_EN')"
#: Where each page lies: under none, one or two of the four names.
_PLACES = f"""SELECT page_id, concat({_doc}, '.html') AS path FROM p WHERE page_id % 5 = 0
  UNION ALL SELECT page_id, concat({_doc}, '.xml') FROM p WHERE page_id % 5 <= 1 UNION ALL SELECT page_id, concat('CRE/', {_doc}, '.html') FROM p WHERE page_id % 5 = 2
  UNION ALL SELECT page_id, concat('document/', {_doc}) FROM p WHERE page_id % 5 BETWEEN 2 AND 3"""


def s8_first_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    files = spark.sql(f"WITH p AS (SELECT * FROM {{pages}}), f AS ({_PLACES}) SELECT path, CAST(concat(path, html) AS binary) AS content FROM f JOIN p ON p.page_id = f.page_id", pages=pages)
    out = landed.first_reports(files, pages.select(F.expr(_id).alias("session_id")))
    return out.select("session_id", "path", "tried", F.md5("content").alias("digest"))


S8 = f"""WITH p AS (SELECT * FROM pages), f AS ({_PLACES}), r AS (SELECT f.page_id, path, CASE WHEN path LIKE 'CRE/%' THEN 3 WHEN path LIKE 'document/%' THEN 4 WHEN path LIKE '%.html' THEN 1 ELSE 2 END AS tried FROM f),
c AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY tried) AS k FROM r)
SELECT {_id.replace('page_id', 'p.page_id')} AS session_id, path, coalesce(tried, 4) AS tried, md5(path || html) AS digest FROM p LEFT JOIN c ON c.page_id = p.page_id AND k = 1"""


def s9_report_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 7 == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 7 != 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", landed.report_address(date, "https://reports.example/doceo", "FR").alias("address"))


S9 = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 1 THEN 'https://reports.example/doceo/CRE-9-' || strftime(o_orderdate, '%Y-%m-%d') || '_FR.html' END AS address FROM orders"""

_ANSWER = """SELECT concat('sessions/', CAST(o_orderkey AS varchar(20)), CASE o_orderkey % 4 WHEN 0 THEN '/documents' WHEN 1 THEN '/documents.json' WHEN 2 THEN '/votes' ELSE '/documents/x' END) AS path, o_orderkey,
  concat('{"results": [{"id": "d', CAST(o_custkey AS varchar(20)), '", "title": "', o_orderpriority, '"}, {"id": "e", "type": "', o_orderstatus, '"}]}') AS body FROM {orders}"""


def s3_session_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    answers = spark.sql(_ANSWER.replace("{", "{{").replace("}", "}}").replace("{{orders}}", "{orders}"), orders=orders).select("path", F.col("body").cast("binary").alias("content"))
    return landed.session_documents(answers, orders.where("o_custkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("session_id")))


S3 = f"""WITH a AS ({_ANSWER.replace("{orders}", "orders")}), w AS (SELECT a.*, o.o_custkey, o.o_orderpriority, o.o_orderstatus FROM a JOIN orders o USING (o_orderkey) WHERE o.o_custkey % 2 = 0 AND o_orderkey % 4 < 2)
SELECT o_orderkey::VARCHAR AS session_id, 'd' || o_custkey AS id, o_orderpriority AS title, NULL::VARCHAR AS type FROM w UNION ALL SELECT o_orderkey::VARCHAR, 'e', NULL, o_orderstatus FROM w"""

PAIRS = {"s8_first_reports": (s8_first_reports, S8), "s9_report_addresses": (s9_report_addresses, S9), "s3_session_documents": (s3_session_documents, S3)}
