"""Rules on records, laid over the given tables; each with SQL of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import records as X

TABLES = ("conversations", "documents", "orders", "events", "labels", "customer")


def on(source: str, apply: Callable[[DataFrame], DataFrame], sql: str, duck: str | None = None):
    """(query, SQL) of an operator on a base statement, which sql reads as `b`."""

    def run(spark, sf_dir):
        used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in source}
        return apply(spark.sql(source, **used))

    other = duck or source
    for t in TABLES:
        other = other.replace("{" + t + "}", t)
    return run, f"WITH b AS ({other}) {sql}"


SAID = """SELECT conv_id, turn, concat(CASE turn % 5 WHEN 0 THEN '' WHEN 1 THEN 'Mr President, ' WHEN 2 THEN '(Applause) ' WHEN 3 THEN 'A QUESTION (laughter) ' ELSE 'so ' END,
  CASE WHEN turn % 7 = 0 THEN '' ELSE coalesce(text, '') END) AS text FROM {conversations}"""
DATES = """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN '2024-01-15' WHEN 1 THEN ' 15/01/2024 ' WHEN 2 THEN '15.01.2024' WHEN 3 THEN '15 January 2024' WHEN 4 THEN 'March 5, 2023'
  WHEN 5 THEN '20240115' WHEN 6 THEN '2024-02-30' WHEN 7 THEN 'soon' END AS s FROM {orders}"""
TIMES = """SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN '2024-01-15' WHEN 1 THEN '2024-01-15T10:30:00Z' WHEN 2 THEN '2024-01-15 10:30' WHEN 3 THEN '2024-01-15T10:30:00.123456+02:00'
  WHEN 4 THEN '2024-13-01' WHEN 5 THEN '2024-01-15T24:30:00' WHEN 6 THEN '2024-01-15T10:61' WHEN 7 THEN '15/01/2024' WHEN 8 THEN '2024-02-30T10:00:00' WHEN 9 THEN '' WHEN 10 THEN '2024-01-15T10:30:00+25:00' END AS s FROM {orders}"""
SPANS = "SELECT o_orderkey, CAST(o_orderdate AS date) AS a, CAST(o_orderdate AS date) + CAST(o_orderkey * 7 % 90 - 5 AS int) AS z, CAST(o_orderkey % 60 AS int) AS size FROM {orders}"
SPANS_SPARK = "SELECT o_orderkey, CAST(o_orderdate AS date) AS a, date_add(CAST(o_orderdate AS date), CAST(o_orderkey * 7 % 90 - 5 AS int)) AS z, CAST(o_orderkey % 60 AS int) AS size FROM {orders}"
ARRIVED = "SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 AND turn % 2 = 0 THEN turn + 1.5E0 ELSE turn END AS arrived FROM {conversations}"
SESSIONS = """SELECT o_orderkey AS id, o_custkey % 50 AS owner, CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'P' THEN 'prioritized' ELSE 'failed' END AS state,
  CAST(substring(o_orderpriority, 1, 1) AS int) AS priority, CAST(o_orderkey * 31 % 1000 AS bigint) AS created, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey * 17 % 2000 AS bigint) END AS scheduled,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey * 13 % 1500 AS bigint) END AS earliest, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey * 11 % 1500 AS bigint) END AS latest,
  CASE WHEN o_orderkey % 6 > 0 THEN CAST(o_totalprice / 1000 AS double) END AS memory, o_orderkey % 97 = 0 AS unknown FROM {orders}"""
PARAGRAPHS = """SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN concat(coalesce(text, ''), '\n\n', coalesce(lang, ''), '\n\n \n\nEnd of the text.\n\n', coalesce(source, '')) ELSE text END AS text FROM {documents}"""

_some = lambda words: "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + ")"
PAIRS = {
    "d3_duration": on(
        SAID, lambda b: b.select("conv_id", "turn", F.round(X.speaking_minutes(F.col("text")), 9).alias("minutes")),
        rf"""SELECT conv_id, turn, CASE WHEN text = '' THEN 0 ELSE round(greatest(len(regexp_extract_all(text, '\S+')) / 150.0::DOUBLE * CASE WHEN {_some(['applause', 'laughter', 'interruption', 'mixed reactions'])} THEN 1.2::DOUBLE ELSE 1 END
        * CASE WHEN {_some(['question', 'answer', 'mr president'])} THEN 1.1::DOUBLE ELSE 1 END, 0.5::DOUBLE), 9) END AS minutes FROM b""",
    ),
    "d5_date_parse": on(
        DATES, lambda b: b.select("o_orderkey", X.written_date(F.col("s")).alias("day")),
        "SELECT o_orderkey, CAST(coalesce(try_strptime(trim(s), '%Y-%m-%d'), try_strptime(trim(s), '%d/%m/%Y'), try_strptime(trim(s), '%d.%m.%Y'), try_strptime(trim(s), '%d %B %Y'), try_strptime(trim(s), '%B %d, %Y')) AS date) AS day FROM b",
    ),
    "d6_iso_validation": on(
        TIMES, lambda b: b.select("o_orderkey", X.is_iso(F.col("s")).alias("valid")),
        r"""SELECT o_orderkey, coalesce(regexp_matches(s, '^\d{4}-\d{2}-\d{2}([T ]([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d{1,9})?)?)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)?)?$') AND try_strptime(s[1:10], '%Y-%m-%d') IS NOT NULL, false) AS valid FROM b""",
    ),
    "w21_date_ranges": on(
        SPANS_SPARK, lambda b: X.date_ranges(b, "a", "z", "size").select("o_orderkey", "first", "last"),
        """, d AS (SELECT *, greatest(7, size // 2) AS days FROM b), k AS (SELECT *, unnest(range(0, 100)) AS k FROM d)
        SELECT o_orderkey, CAST(a + (k * (days + 1))::INT AS date) AS first, CAST(least(a + (k * (days + 1) + days)::INT, z) AS date) AS last FROM k WHERE a + (k * (days + 1))::INT < z""",
        SPANS,
    ),
    "w9_order_check": on(ARRIVED, lambda b: X.out_of_order(b, "conv_id", ["arrived", "turn"], "turn"), "SELECT conv_id, list(turn ORDER BY arrived, turn) <> list(turn ORDER BY turn) AS out_of_order FROM b GROUP BY conv_id"),
    "n3_map_merge": on(
        "SELECT d.doc_id, map('lang', d.lang, 'source', d.source) AS a, CASE WHEN l.quality = 1 THEN map('lang', 'checked', 'toxic', CAST(l.toxic AS string)) END AS z FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
        lambda b: b.select("doc_id", F.explode(X.merged(F.col("a"), F.col("z"))).alias("key", "value")),
        """SELECT doc_id, 'lang' AS key, CASE WHEN quality = 1 THEN 'checked' ELSE lang END AS value FROM b UNION ALL SELECT doc_id, 'source', source FROM b UNION ALL SELECT doc_id, 'toxic', toxic::VARCHAR FROM b WHERE quality = 1""",
        "SELECT d.*, l.quality, l.toxic FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
    ),
    "a23_paragraph_spread": on(
        PARAGRAPHS, lambda b: X.paragraph_spread(b, "doc_id", "text").select("doc_id", "n", *(F.round(c, 6).alias(c) for c in ("mean", "spread", "variation")), "score"),
        r""", p AS (SELECT doc_id, trim(regexp_replace(unnest(string_split(coalesce(text, ''), chr(10) || chr(10))), '^\s+|\s+$', '', 'g')) AS p FROM b),
        s AS (SELECT doc_id, count(*) FILTER (p <> '') AS n, avg(length(p)) FILTER (p <> '') AS mean, coalesce(stddev_samp(length(p)) FILTER (p <> ''), 0) AS spread FROM p GROUP BY doc_id)
        SELECT doc_id, n::INT AS n, round(mean, 6) AS mean, round(spread, 6) AS spread, round(coalesce(spread / mean, 0), 6) AS variation,
        CASE WHEN n = 0 THEN 0 WHEN n > 1 AND spread / mean BETWEEN 0.3 AND 1.5 THEN 0.8 ELSE 0.5 END::DOUBLE AS score FROM s""",
    ),
    "k2_time_schedule": on(
        SESSIONS, lambda b: X.schedule(b.withColumn("needs", F.expr("CASE WHEN memory IS NOT NULL THEN IF(unknown, map('memory', memory, 'gpu', 1.0D), map('memory', memory)) END")), F.lit(800).cast("long"), {"memory": 150.0}).select("id", "owner", "overdue", "place"),
        """SELECT id, owner, coalesce(800 > latest, false) AS overdue, row_number() OVER (PARTITION BY owner ORDER BY coalesce(scheduled, 800), priority, created, id)::INT AS place FROM b
        WHERE state IN ('queued', 'prioritized') AND (earliest IS NULL OR earliest <= 800) AND (memory IS NULL OR (memory <= 150 AND NOT unknown))""",
    ),
    "a24_validation_statistics": on(
        "SELECT user_id, event_id, value AS spent, CAST(event_id % 3 AS int) AS critical, CASE WHEN value > 120 THEN 'excellent' WHEN value > 60 THEN 'good' ELSE 'poor' END AS level FROM {events}",
        lambda b: X.validation_statistics(b, "user_id", "spent", "critical", "level").select("user_id", "assessments", F.round("mean", 6).alias("mean"), F.round("critical_rate", 9).alias("critical_rate"), F.explode("levels").alias("level", "n")),
        """, s AS (SELECT user_id, count(*) AS assessments, round(avg(spent), 6) AS mean, round(sum(critical) / count(*), 9) AS critical_rate FROM b GROUP BY user_id)
        SELECT s.*, level, count(*) AS n FROM b JOIN s USING (user_id) GROUP BY ALL""",
    ),
}
