"""Structured Streaming forms: trailing counts with a watermark, and the breaker as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.sequences import Breaker


def windowed_counts(events: DataFrame, width: str = "1 hour", slide: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Requests per service and sliding window; rows later than the watermark are dropped. Works on batches too."""
    e = events.withColumn("at", F.col("ts").cast("timestamp"))
    e = e.withWatermark("at", late) if e.isStreaming else e
    out = e.groupBy(F.window("at", width, slide).alias("w"), "event_type").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "failed")


def breaker_stream(events: DataFrame, **limits) -> DataFrame:
    """user_id, event_id, allowed, state per event, with each user's breaker kept as state between batches."""

    def step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        breaker = Breaker(**limits)
        if state.exists:
            breaker.state, breaker.count, breaker.good, breaker.since = state.get
        for f in frames:
            f = f.sort_values(["at", "event_id"])
            out = [(key[0], r.event_id, *breaker.step(r.at, r.event_type != "error")) for r in f.itertuples()]
            yield pd.DataFrame(out, columns=["user_id", "event_id", "allowed", "state"])
        state.update((breaker.state, breaker.count, breaker.good, breaker.since))

    e = events.select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").cast("double").alias("at"))
    return e.groupBy("user_id").applyInPandasWithState(step, "user_id long, event_id long, allowed boolean, state string", "state string, count int, good int, since double", "append", "NoTimeout")
