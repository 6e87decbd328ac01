"""Queries on stores, logs and outputs that are written and read again, and SQL for what must come back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import lifecycle as L
from lectern.sources import sinks
from lectern.sources.segments import SEGMENTS_SQL, segments
from lectern.sources.stores import Cache, Checkpoints, shared_folder
from lectern.streaming import event_log


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))


def s12_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders saved whole, then their changes, twice: the rows of each version, and the latest after compaction."""
    store, orders = Checkpoints(spark, shared_folder(spark, "checkpoints")), _orders(spark, sf_dir)
    store.save("orders", orders.where("o_orderkey % 11 <> 0"), "o_orderkey")
    second = orders.where("o_orderkey % 7 <> 0").withColumn("price", F.when(F.col("o_orderkey") % 5 == 0, F.col("price") + 1).otherwise(F.col("price")))
    store.save_changes("orders", second, "o_orderkey")
    store.save_changes("orders", orders.where("status <> 'P'"), "o_orderkey")
    store.compact("orders")
    said = lambda v: store.load("orders", v).select(F.lit(v).alias("version"), "o_orderkey", "status", "price")
    return said(1).unionByName(said(2)).unionByName(said(3)).unionByName(said(4))


S12 = """WITH o AS (SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders)
SELECT 1 AS version, * FROM o WHERE o_orderkey % 11 <> 0
UNION ALL SELECT 2, o_orderkey, status, CASE WHEN o_orderkey % 5 = 0 THEN price + 1 ELSE price END FROM o WHERE o_orderkey % 7 <> 0
UNION ALL SELECT v, o.* FROM o, unnest([3, 4]) AS u(v) WHERE status <> 'P'"""


def r6_restore_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each way of restoring makes of changed saves and a current table that lacks some of them."""
    store, orders = Checkpoints(spark, shared_folder(spark, "restores")), _orders(spark, sf_dir)
    store.save("orders", orders.where("o_orderkey % 3 = 0"), "o_orderkey")
    store.save_changes("orders", orders.where("o_orderkey % 4 = 0").withColumn("status", F.lit("X")), "o_orderkey")
    current = orders.where("o_orderkey % 2 = 0 AND o_orderkey % 12 <> 0")
    out = None
    for mode in ("full", "partial", "merge", "incremental"):
        own = store.restore("orders", current, mode, done=F.col("price") > 200_000).select(F.lit(mode).alias("mode"), "o_orderkey", "status", "price")
        out = own if out is None else out.unionByName(own)
    return out


R6 = """WITH o AS (SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders), s AS (SELECT o_orderkey, 'X' AS status, price FROM o WHERE o_orderkey % 4 = 0)
SELECT 'full' AS mode, * FROM s UNION ALL SELECT 'partial', * FROM s WHERE price > 200000
UNION ALL SELECT m, s.* FROM s, unnest(['merge', 'incremental']) AS u(m)
UNION ALL SELECT m, o.* FROM o, unnest(['merge', 'incremental']) AS u(m) WHERE o_orderkey % 2 = 0 AND o_orderkey % 12 <> 0 AND o_orderkey % 4 <> 0"""

KINDS = ["api_responses", "integration_results", "session_discovery", "verbatim_content", "other"]


def s10_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of three moments through one cache: how many of each kind hit, and what they got."""
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("o_custkey") % len(KINDS)).cast("int") + 1)
    asked = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_custkey").cast("string").alias("key"), kind.alias("kind"))
    cache, out = Cache(spark, shared_folder(spark, "cache"), lambda k: L.cache_hours(k), shards=8), None
    for k, (hour, some) in enumerate(((0, "o_orderkey % 3 = 0"), (2, "o_orderkey % 3 <> 1"), (30, "true"))):
        told = cache.through(asked.where(some), lambda m, k=k: m.withColumn("value", F.concat_ws(":", F.lit(k), "kind", "key")), hour * 3600.0)
        own = told.groupBy("kind", "hit", F.substring("value", 1, 1).cast("int").alias("made")).agg(F.count("*").alias("n")).withColumn("run", F.lit(k))
        own.write.parquet(f"{cache.top}/_run-{k}")  # the next run rewrites what this one reads
        stood = spark.read.parquet(f"{cache.top}/_run-{k}")
        out = stood if out is None else out.unionByName(stood)
    return out


_kind = "[" + ", ".join(f"'{k}'" for k in KINDS) + f"][o_custkey % {len(KINDS)} + 1]"
_hours = "CASE kind WHEN 'api_responses' THEN 0.5 WHEN 'integration_results' THEN 4 WHEN 'session_discovery' THEN 24 WHEN 'verbatim_content' THEN 168 ELSE 1 END"
S10 = f"""WITH r AS (SELECT o_orderkey, o_custkey AS key, {_kind} AS kind, run, [0, 2, 30][run + 1] AS hour FROM orders, unnest([0, 1, 2]) AS u(run)
    WHERE run = 2 OR (run = 1 AND o_orderkey % 3 <> 1) OR (run = 0 AND o_orderkey % 3 = 0)),
f AS (SELECT key, kind, min(run) FILTER (run = 0) AS r0, min(run) FILTER (run = 1) AS r1, any_value({_hours}) AS h FROM r GROUP BY key, kind),
t AS (SELECT r.*, r0, r1, h, CASE WHEN r0 IS NOT NULL AND (r1 IS NULL OR 2 <= h) THEN 0 WHEN r1 IS NOT NULL THEN 1 END AS last FROM r JOIN f USING (key, kind)),
v AS (SELECT *, CASE run WHEN 0 THEN false WHEN 1 THEN r0 IS NOT NULL AND 2 <= h ELSE coalesce(30 - [0, 2][last + 1] <= h, false) END AS hit FROM t)
SELECT kind, hit, CASE WHEN NOT hit THEN run WHEN run = 1 THEN 0 ELSE last END AS made, run, count(*) AS n FROM v GROUP BY ALL"""


def r5_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream into a log, alerts and notifications of subscribers; then what stands in each."""
    stream = event_log.table_stream(spark, sf_dir, "events").withColumn("operation", F.col("user_id") % 40)
    who = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("subscriber"), F.when(F.col("n_regionkey") > 0, F.col("n_nationkey")).alias("operation"))
    top = shared_folder(spark, "events")
    event_log.fan_out(
        stream, {"log": lambda b: b, "alerts": lambda b: b.where("event_type = 'error'"), "notifications": lambda b: event_log.notifications(b, who)}, top
    )
    counts = lambda name, who: event_log.read(spark, top, name).groupBy(F.lit(name).alias("sink"), who.alias("subscriber"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    none = F.lit(None).cast("string")
    return counts("log", none).unionByName(counts("alerts", none)).unionByName(counts("notifications", F.col("subscriber")))


R5 = """WITH e AS (SELECT *, user_id % 40 AS operation FROM events), s AS (SELECT n_name AS subscriber, CASE WHEN n_regionkey > 0 THEN n_nationkey END AS operation FROM nation),
a AS (SELECT 'log' AS sink, NULL::VARCHAR AS subscriber, event_type, value FROM e UNION ALL SELECT 'alerts', NULL, event_type, value FROM e WHERE event_type = 'error'
  UNION ALL SELECT 'notifications', s.subscriber, event_type, value FROM e JOIN s ON s.operation = e.operation OR s.operation IS NULL)
SELECT sink, subscriber, event_type, count(*) AS n, round(sum(value), 2) AS total FROM a GROUP BY ALL"""


def _output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select(
        F.col("speaker").alias("speaker_name"), F.lit(None).cast("string").alias("speaker_country"), F.when(F.col("seq") % 3 == 0, F.col("session_id").cast("string")).alias("segment_start_ts"),
        F.col("seq").alias("segment_end_ts"), F.concat(F.lit(" \n"), F.coalesce("text", F.lit("")), F.lit('\t "said"\n ')).alias("speech_text"),
        F.when(F.col("seq") % 2 == 0, F.length("text") < 60).alias("is_announcement"), F.when(F.col("seq") % 5 == 0, "session").alias("announcement_label"),
    )


def s15_written_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in both formats after a write, row by row, and the figures that were observed while writing."""
    path = shared_folder(spark, "output")
    told = sinks.write_output(_output(spark, sf_dir), path)
    own = lambda kind: sinks.read_output(spark, path, kind).groupBy(F.lit(kind).alias("format"), *sinks.OUTPUT).agg(F.count("*").alias("n"))
    figures = spark.createDataFrame([{"format": "figures", **{c: "" for c in sinks.OUTPUT}, "speaker_name": k, "n": v} for k, v in told.items() if k != "files"], own("csv").schema)
    return own("csv").unionByName(own("jsonl")).unionByName(figures)


_o = rf"""SELECT coalesce(speaker, '') AS speaker_name, '' AS speaker_country, '' AS speaker_party_or_group, CASE WHEN seq % 3 = 0 THEN session_id::VARCHAR ELSE '' END AS segment_start_ts,
  seq::VARCHAR AS segment_end_ts, regexp_replace(coalesce(text, '') || chr(9) || ' "said"', '^\s+', '') AS speech_text,
  CASE WHEN seq % 2 = 0 AND length(text) < 60 THEN 'true' ELSE 'false' END AS is_announcement, CASE WHEN seq % 5 = 0 THEN 'session' ELSE '' END AS announcement_label FROM ({SEGMENTS_SQL})"""
S15 = f"""WITH o AS ({_o}), f AS (SELECT count(*) AS segments, count(*) FILTER (is_announcement = 'true') AS announcements, count(*) FILTER (speaker_name <> '') AS with_speaker, 0::BIGINT AS with_country,
    count(*) FILTER (segment_start_ts <> '' AND segment_end_ts <> '') AS with_times, sum(length(speech_text))::BIGINT AS characters FROM o)
SELECT format, o.*, count(*) AS n FROM o, unnest(['csv', 'jsonl']) AS u(format) GROUP BY ALL
UNION ALL SELECT 'figures', k, '', '', '', '', '', '', '', v FROM (UNPIVOT f ON COLUMNS(*) INTO NAME k VALUE v)"""

PAIRS = {
    "s12_checkpoints": (s12_checkpoints, S12),
    "r6_restore_modes": (r6_restore_modes, R6),
    "s10_cache": (s10_cache, S10),
    "r5_event_log": (r5_event_log, R5),
    "s15_written_output": (s15_written_output, S15),
}
