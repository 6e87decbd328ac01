"""Life cycles of operations in stages: percent, throughput, failures, what a step completes; stuck and finished ones.

One state machine serves both forms. In a batch, an operation's events stream through a sorted partition, so one with
most of all events needs no more memory. In a stream, the state of an operation is kept between micro-batches, and
event-time timers tell which operations are stuck and forget those that finished.

Events: operation, seq, at (a timestamp), stage, kind (progress, complete, fail, retry), percent, items, final (whether a
failure ends the operation). Those of one operation are taken in order of at and seq. A null percent counts as 0; null
items leave the throughput as it was; other kinds change nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STUCK_HOURS, FORGET_HOURS = 6.0, 1.0
TOLD = "operation long, seq long, stage string, stage_status string, percent double, throughput double, failures long, completes string, overall double, status string"
COLUMNS = [c.split()[0] for c in TOLD.split(", ")]


class Stages:
    """What is known of one operation: its current stage and, of each stage, percent, start, throughput, failures, status."""

    def __init__(self, names: list[str], known: dict | None = None):
        self.names = names
        self.current, self.failed, self.of = (known["current"], known["failed"], known["of"]) if known else (None, False, {})

    def known(self) -> dict:
        return {"current": self.current, "failed": self.failed, "of": self.of}

    def finished(self) -> bool:
        return self.failed or all(self.of.get(n, {}).get("status") == "completed" for n in self.names)

    def step(self, at: float, stage: str, kind: str, percent: float | None, items: float | None, final: bool) -> tuple:
        """stage_status, percent, throughput, failures, completes, overall, status after this event."""
        own = self.of.setdefault(stage, {"percent": 0.0, "since": None, "rate": 0.0, "failures": 0, "status": "not_started"})
        completes = None
        if kind == "progress":
            own["percent"], own["status"] = min(100.0, max(0.0, percent or 0.0)), "in_progress"
            own["since"] = at if own["since"] is None else own["since"]
            if items is not None and at > own["since"]:
                own["rate"] = items / (at - own["since"])
            if self.current not in (None, stage) and self.of[self.current]["percent"] >= 100.0:
                completes, self.of[self.current]["status"] = self.current, "completed"
            self.current = stage
        elif kind == "complete":
            own["percent"], own["status"] = 100.0, "completed"
        elif kind == "fail":
            own["failures"], own["status"], self.failed = own["failures"] + 1, "failed", self.failed or final
        elif kind == "retry":
            own["percent"], own["status"] = 0.0, "in_progress"
        overall = sum(self.of.get(n, {"percent": 0.0})["percent"] for n in self.names) / len(self.names)
        return own["status"], own["percent"], own["rate"], own["failures"], completes, overall, "failed" if self.failed else "completed" if self.finished() else "running"

    def rows(self, operation: int, f: pd.DataFrame) -> Iterator[tuple]:
        none = lambda x: None if x is None or x != x else x
        for seq, at, stage, kind, percent, items, final in zip(*(f[c] for c in ("seq", "at", "stage", "kind", "percent", "items", "final"))):
            stage_status, *rest = self.step(at, stage, kind, none(percent), none(items), bool(final))
            yield (operation, seq, stage, stage_status, *rest)


def _plain(events: DataFrame) -> DataFrame:
    return events.select("operation", "seq", F.col("at").cast("timestamp").cast("double").alias("at"), "stage", "kind", F.col("percent").cast("double"), F.col("items").cast("double"), F.coalesce("final", F.lit(False)).alias("final"))


def stage_states(events: DataFrame, names: list[str]) -> DataFrame:
    """What each event of a batch leads to."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, stages = None, None
        for f in frames:
            out = []
            starts = [0, *(f["operation"].ne(f["operation"].shift()).to_numpy().nonzero()[0][1:] if len(f) else []), len(f)]
            for a, b in zip(starts, starts[1:]):
                part = f.iloc[a:b]
                if len(part):
                    operation = part["operation"].iloc[0]
                    if operation != now:
                        now, stages = operation, Stages(names)
                    out += stages.rows(operation, part)
            yield pd.DataFrame(out, columns=COLUMNS)

    dealt = _plain(events).repartition(F.col("operation")).sortWithinPartitions("operation", "at", "seq")
    return dealt.mapInPandas(run, TOLD)


class StageProcessor(StatefulProcessor):
    """The state machine with timers: STUCK_HOURS after its last event a running operation is told as stuck, once;
    FORGET_HOURS after its last event a finished one is told as evicted and forgotten."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        self.handle, self.kept = handle, handle.getValueState("stages", "known string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        f = pd.concat(list(rows), ignore_index=True)
        f["at"] = f["time"].map(lambda t: t.timestamp() if t.tzinfo else t.replace(tzinfo=timezone.utc).timestamp())
        f = f.sort_values(["at", "seq"], kind="stable")
        known = json.loads(self.kept.get()[0]) if self.kept.exists() else None
        stages = Stages(self.names, known)
        out = list(stages.rows(key[0], f))
        last = max(f["at"].iloc[-1], (known or {}).get("last", 0.0))
        self.kept.update((json.dumps(stages.known() | {"last": last}),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(1000 * (last + 3600 * (FORGET_HOURS if stages.finished() else STUCK_HOURS))))
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.kept.exists():
            return
        stages = Stages(self.names, json.loads(self.kept.get()[0]))
        told = "evicted" if stages.finished() else "stuck"
        if told == "evicted":
            self.kept.clear()
        overall = sum(stages.of.get(n, {"percent": 0.0})["percent"] for n in self.names) / len(self.names)
        yield pd.DataFrame([(key[0], None, stages.current, None, None, None, None, None, overall, told)], columns=COLUMNS).astype({"seq": "Int64", "failures": "Int64"})

    def close(self) -> None:
        pass


def stage_stream(events: DataFrame, names: list[str], late: str = "10 minutes") -> DataFrame:
    """The same of a stream, and a row with status stuck or evicted for each timer that the watermark passes. Needs the
    RocksDB state store (spark.sql.streaming.stateStore.providerClass)."""
    e = events.withColumn("time", F.col("at").cast("timestamp")).withWatermark("time", late)
    some = e.select("operation", "seq", "time", "stage", "kind", F.col("percent").cast("double"), F.col("items").cast("double"), F.coalesce("final", F.lit(False)).alias("final"))
    return some.groupBy("operation").transformWithStateInPandas(statefulProcessor=StageProcessor(names), outputStructType=TOLD, outputMode="Append", timeMode="EventTime")


def closing(states: DataFrame, now: datetime) -> DataFrame:
    """Of states (operation, last, status): running ones that are stuck and finished ones to be evicted, with that verdict."""
    hours = (F.lit(now).cast("timestamp").cast("double") - F.col("last").cast("timestamp").cast("double")) / 3600
    verdict = F.when((F.col("status") == "running") & (hours > STUCK_HOURS), "stuck").when((F.col("status") != "running") & (hours > FORGET_HOURS), "evicted")
    return states.withColumn("verdict", verdict).where("verdict IS NOT NULL")
