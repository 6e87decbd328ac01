"""Queries on stage life cycles; users stand for operations, events for what their stages report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.streaming import stages as S

NAMES = ["find", "parse", "store"]
BASE = """SELECT user_id AS operation, event_id AS seq, ts AS at, CASE event_id % 3 WHEN 0 THEN 'find' WHEN 1 THEN 'parse' ELSE 'store' END AS stage,
  CASE event_id % 8 WHEN 0 THEN 'fail' WHEN 1 THEN 'complete' WHEN 2 THEN 'retry' ELSE 'progress' END AS kind,
  CASE WHEN event_id % 17 > 0 THEN CAST(event_id * 37 % 150 AS DOUBLE) - 10 END AS percent,
  CASE WHEN event_id % 13 > 0 THEN CAST(event_id % 40 AS DOUBLE) END AS items, event_id % 512 = 0 AS final FROM {events}"""


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.sql(BASE, events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    return S.stage_states(events, NAMES)


def r11_stage_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).withColumn("throughput", F.round("throughput", 9)).withColumn("overall", F.round("overall", 6))


def r3_stuck_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations by the status that their last event left, judged at the time of the last event of all."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    last = events.groupBy(F.col("user_id").alias("operation")).agg(F.max(F.struct("ts", "event_id")).alias("z"))
    ended = last.join(_states(spark, sf_dir).select("operation", "seq", "status"), "operation").where("seq = z.event_id")
    now = events.agg(F.max("ts")).first()[0]
    return S.closing(ended.select("operation", F.col("z.ts").alias("last"), "status"), now).select("operation", "status", "verdict")


_last = lambda x: f"last_value({x} IGNORE NULLS) OVER o"
_of = lambda n, x: f"CASE WHEN stage = '{n}' THEN {x} END"
R11 = f"""WITH b AS ({BASE.format(events="events")}),
v AS (SELECT *, epoch("at") AS sec, CASE kind WHEN 'progress' THEN least(100.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(percent, 0))) WHEN 'complete' THEN 100.0::DOUBLE WHEN 'retry' THEN 0.0::DOUBLE END AS own,
    CASE kind WHEN 'complete' THEN 'completed' WHEN 'fail' THEN 'failed' ELSE 'in_progress' END AS stage_status FROM b),
p AS (SELECT *, coalesce(last_value(own IGNORE NULLS) OVER s, 0.0::DOUBLE) AS pct, min(CASE WHEN kind = 'progress' THEN sec END) OVER s AS since, count(*) FILTER (kind = 'fail') OVER s AS failures,
    last_value(CASE WHEN kind = 'progress' THEN stage END IGNORE NULLS) OVER (PARTITION BY operation ORDER BY sec, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
    row_number() OVER (PARTITION BY operation ORDER BY sec, seq) AS k
  FROM v WINDOW s AS (PARTITION BY operation, stage ORDER BY sec, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'progress' AND items IS NOT NULL AND sec > since THEN items / (sec - since) END IGNORE NULLS)
    OVER (PARTITION BY operation, stage ORDER BY sec, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0::DOUBLE) AS rate FROM p),
c AS (SELECT r.*, CASE WHEN r.kind = 'progress' AND r.prev <> r.stage AND x.pct >= 100 THEN r.prev END AS completes
  FROM r ASOF LEFT JOIN p x ON r.operation = x.operation AND r.prev = x.stage AND r.k > x.k),
t AS (SELECT *, ({" + ".join(f"coalesce({_last(_of(n, 'pct'))}, 0)" for n in NAMES)}) / 3 AS overall, bool_or(kind = 'fail' AND final) OVER o AS dead,
    {" AND ".join(f"coalesce({_last(f'CASE WHEN stage = {chr(39)}{n}{chr(39)} THEN stage_status WHEN completes = {chr(39)}{n}{chr(39)} THEN {chr(39)}completed{chr(39)} END')}, '') = 'completed'" for n in NAMES)} AS whole
  FROM c WINDOW o AS (PARTITION BY operation ORDER BY sec, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT operation, seq, stage, stage_status, pct AS percent, round(rate, 9) AS throughput, failures, completes, round(overall, 6) AS overall,
  CASE WHEN dead THEN 'failed' WHEN whole THEN 'completed' ELSE 'running' END AS status FROM t"""
R3 = f"""WITH t AS ({R11}), z AS (SELECT t.operation, t.status, e.ts, row_number() OVER (PARTITION BY t.operation ORDER BY e.ts DESC, t.seq DESC) AS k FROM t JOIN events e ON e.event_id = t.seq),
n AS (SELECT max(ts) AS now FROM events)
SELECT operation, status, CASE WHEN status = 'running' THEN 'stuck' ELSE 'evicted' END AS verdict FROM z, n
WHERE k = 1 AND epoch(now) - epoch(ts) > CASE WHEN status = 'running' THEN 21600 ELSE 3600 END"""

PAIRS = {"r11_stage_progress": (r11_stage_progress, R11), "r3_stuck_executions": (r3_stuck_executions, R3)}
