"""What the periodic loops find, on events replayed as executions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.streaming import loops

BASE = """SELECT event_id AS id, user_id % 5 AS service, CAST(sec AS double) AS start,
  CASE WHEN event_id % 11 > 0 THEN sec + event_id * 37 % 600 * 60.0E0 END AS "end", value / 200.0E0 + CASE WHEN user_id % 5 > 2 THEN 0.35E0 ELSE 0.25E0 END AS quality FROM e"""


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("sec", F.col("ts").cast("timestamp").cast("double"))
    return spark.sql(BASE.replace('"end"', "end").replace("FROM e", "FROM {e}"), e=e)


def r2_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = executions(spark, sf_dir)
    now = e.agg(F.max("start")).first()[0] or 0.0
    row = lambda name, df, key, n, more, mean: df.select(F.lit(name).alias("loop"), key.cast("long").alias("service"), "tick", n.cast("long").alias("n"), more.cast("long").alias("more"), F.round(mean.cast("double"), 9).alias("mean"))
    none = F.lit(None)
    return (
        row("discovery", loops.discovered(e, "start"), none, F.col("n"), none, none)
        .unionByName(row("monitoring", loops.monitored(e, now), none, F.col("stuck"), F.col("evicted"), none))
        .unionByName(row("quality", loops.quality(e, "service"), F.col("service"), F.col("n"), F.col("alert").cast("int"), F.col("mean")))
    )


R2 = f"""WITH e AS (SELECT *, epoch(ts) AS sec FROM events), b AS ({BASE}), n AS (SELECT max(start) AS now FROM b),
m AS (SELECT (floor((start + 21600) / 1800) + 1) * 1800 AS first, (floor(("end" + 3600) / 1800) + 1) * 1800 AS gone FROM b),
t AS (SELECT first AS tick FROM m WHERE gone IS NULL OR first <= gone UNION SELECT gone + 1800 FROM m WHERE first <= gone UNION SELECT gone FROM m WHERE gone IS NOT NULL),
q AS (SELECT *, (floor("end" / 3600) + 1) * 3600 AS tick FROM b WHERE "end" IS NOT NULL),
k AS (SELECT DISTINCT service, tick FROM q),
r AS (SELECT k.service, k.tick, q."end", q.quality, row_number() OVER (PARTITION BY k.service, k.tick ORDER BY q."end" DESC, q.id DESC) AS i FROM k JOIN q ON q.service = k.service AND q.tick <= k.tick AND q.tick > k.tick - 691200),
a AS (SELECT service, tick, count(*) AS n, avg(quality) AS mean FROM r WHERE i <= 100 AND tick - "end" < 604800 GROUP BY service, tick HAVING count(*) >= 10)
SELECT 'discovery' AS loop, NULL::BIGINT AS service, ((floor(start / 21600) + 1) * 21600)::BIGINT AS tick, count(*) AS n, NULL::BIGINT AS more, NULL::DOUBLE AS mean FROM b GROUP BY 3
UNION ALL SELECT 'monitoring', NULL, tick::BIGINT, (SELECT count(*) FROM m WHERE first <= t.tick AND (gone IS NULL OR gone >= t.tick)), (SELECT count(*) FROM m WHERE gone = t.tick), NULL FROM t, n WHERE tick <= now
UNION ALL SELECT 'quality', service, tick::BIGINT, n, (mean < 0.5)::INT, round(mean, 9) FROM a"""

PAIRS = {"r2_loops": (r2_loops, R2)}
