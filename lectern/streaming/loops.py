"""The work of periodic loops, told for every tick: discovery, monitoring of executions, quality over a trailing span.

A loop wakes at whole multiples of its interval. What it would find at a tick follows from each record's own times, so
replayed records need no clock and no row for each tick: a record knows its first tick, and running sums tell the rest.
tumbling() is the form for streams, with a watermark and a trigger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed values, in seconds: how often each loop wakes.
DISCOVERY, MONITORING, QUALITY = 6 * 3600, 1800, 3600
STUCK_AFTER, FORGOTTEN_AFTER = 6 * 3600, 3600
TRAILING, LATEST, FEWEST, POOR = 7 * 86400, 100, 10, 0.5


def tick_after(at: Column, every: int) -> Column:
    """The first tick later than a time in seconds."""
    return ((F.floor(at / every) + 1) * every).cast("long")


def discovered(sessions: DataFrame, created: str = "created") -> DataFrame:
    """tick, n: sessions that a tick is the first to find."""
    return sessions.groupBy(tick_after(F.col(created), DISCOVERY).alias("tick")).agg(F.count("*").alias("n"))


def monitored(executions: DataFrame, now: float, start: str = "start", end: str = "end") -> DataFrame:
    """tick, stuck, evicted, for every tick up to now at which one of them changes: executions that began over
    STUCK_AFTER ago and are still kept, and those that go since they ended over FORGOTTEN_AFTER ago (they are still
    looked at in that tick). Null ends: still running."""
    gone = tick_after(F.col(end) + FORGOTTEN_AFTER, MONITORING)
    first = tick_after(F.col(start) + STUCK_AFTER, MONITORING)
    both = executions.select(first.alias("first"), gone.alias("gone"))
    held = both.where(F.col("gone").isNull() | (F.col("first") <= F.col("gone")))
    change = lambda df, tick, n, out: df.select(tick.cast("long").alias("tick"), F.lit(n).alias("change"), F.lit(out).alias("out"))
    steps = change(held, F.col("first"), 1, 0).unionByName(change(held.where("gone IS NOT NULL"), F.col("gone") + MONITORING, -1, 0)).unionByName(change(both.where("gone IS NOT NULL"), F.col("gone"), 0, 1))
    # One row for each tick is left when they are run over in order.
    by_tick = steps.where(F.col("tick") <= now).groupBy("tick").agg(F.sum("change").alias("change"), F.sum("out").alias("evicted"))
    told = by_tick.withColumn("stuck", F.sum("change").over(W.orderBy("tick").rowsBetween(W.unboundedPreceding, 0)))
    return told.select("tick", "stuck", F.col("evicted").cast("long"))


def quality(executions: DataFrame, key: str, value: str = "quality", end: str = "end", id_: str = "id") -> DataFrame:
    """key, tick, n, mean, alert: at each tick that follows an end, over the LATEST executions of the key that had ended,
    as far as they ended within TRAILING; only where there are FEWEST at least."""
    done = executions.where(F.col(end).isNotNull()).withColumn("__tick", tick_after(F.col(end), QUALITY))
    recent = W.partitionBy(key).orderBy(end, id_).rowsBetween(1 - LATEST, 0)
    # Only a tick's last row is read, so only its window is gathered.
    last = F.lead("__tick").over(W.partitionBy(key).orderBy(end, id_))
    rows = done.withColumn("__rows", F.collect_list(F.struct(F.col(end).alias("e"), F.coalesce(value, F.lit(0.0)).alias("v"))).over(recent)).withColumn("__next", last)
    ends = rows.where(F.col("__next").isNull() | (F.col("__next") > F.col("__tick")))
    some = F.filter("__rows", lambda r: F.col("__tick") - r["e"] < TRAILING)
    mean = F.aggregate("__some", F.lit(0.0), lambda a, r: a + r["v"]) / F.size("__some")
    told = ends.withColumn("__some", some).where(F.size("__some") >= FEWEST)
    return told.select(key, F.col("__tick").alias("tick"), F.size("__some").cast("long").alias("n"), mean.alias("mean"), (mean < POOR).alias("alert"))


def tumbling(records: DataFrame, at: str, every: int, key: str, value: str, late: str = "10 minutes") -> DataFrame:
    """start, key, n, mean of each stretch of `every` seconds; of a stream once the watermark has passed it."""
    e = records.withColumn("__at", F.col(at).cast("timestamp"))
    e = e.withWatermark("__at", late) if e.isStreaming else e
    out = e.groupBy(F.window("__at", f"{every} seconds").alias("w"), key).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return out.select(F.col("w.start").alias("start"), key, "n", "mean")


def start(told: DataFrame, path: str, every: int | None = None):
    """Writes what a stream tells to a folder; every `every` seconds for good, or all that is there now and no more."""
    out = told.writeStream.format("parquet").outputMode("append").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/progress")
    return (out.trigger(processingTime=f"{every} seconds") if every else out.trigger(availableNow=True)).start()
