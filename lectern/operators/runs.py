"""A run over sessions that can stop and go on: what is pending, what each phase makes of it, and what is committed.

A batch's rows are written into a folder of their own and count once its manifest is published. A batch that was cut off
has no manifest, so its sessions are pending again and its rows are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.operators.sequences import normalized_names
from lectern.sources.stores import Files

Phase = Callable[[DataFrame], DataFrame]

#: Entities that plain text is freed of; the ampersand last, so that none is read twice.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def plain_text(html: Column) -> Column:
    """Without scripts, styles, tags and entities, white space collapsed."""
    out = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</(?:script|style)\s*>", " "), r"<[^>]+>", " ")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(out, r"\s+", " "), r"^\s+|\s+$", "")


def enhanced(segments: DataFrame, speaker: str = "speaker", text: str = "text", confidence: str | None = None) -> DataFrame:
    """segments with the speaker's bare name and clean text, enhanced set; those go whose name has under two characters,
    whose text has under ten, or whose confidence is under a tenth. A speaker that no pattern reads stays as it was."""
    raw = F.regexp_replace(F.coalesce(speaker, F.lit("")), r"^\s+|\s+$", "")
    found = F.coalesce(*(F.nullif(F.regexp_replace(F.regexp_extract(raw, p, 1), r"^\s+|\s+$", ""), F.lit("")) for p in R.SPEAKER_PREFIXES))
    told = normalized_names(segments.withColumn("__found", found), "__found")
    name = F.when(F.col("__found").isNotNull(), F.col("plain_name")).otherwise(F.col(speaker))
    out = told.withColumn(speaker, name).withColumn(text, plain_text(F.col(text))).withColumn("enhanced", F.lit(True)).drop("__found", "plain_name")
    keep = (F.length(speaker) >= R.LEAST_SPEAKER) & (F.length(text) >= R.LEAST_TEXT)
    return out.where(keep if confidence is None else keep & (F.col(confidence) >= R.LEAST_CONFIDENCE))


def simple_announcement(text: Column, role: Column) -> Column:
    """By a president's role, by a phrase, or by having few words."""
    low, who = F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(role, F.lit("")))
    some = F.regexp_count(low, F.lit(r"\S+")) < R.SIMPLE_WORDS
    for r in R.SIMPLE_ROLES:
        some = some | F.contains(who, F.lit(r))
    for p in R.SIMPLE_ANNOUNCEMENTS:
        some = some | low.rlike(p)
    return some


class Run:
    """Phases over sessions; each takes and returns rows with `session_id`, the first takes the pending sessions."""

    def __init__(self, spark: SparkSession, top: str, phases: list[tuple[str, Phase]]):
        self.spark, self.top, self.phases, self.files = spark, top, phases, Files(spark, top)

    def batches(self) -> list[dict]:
        names = [x for x in self.files.names(f"{self.top}/manifest") if x.endswith(".json")]
        return sorted((json.loads(self.files.read(f"{self.top}/manifest/{x}")) for x in names), key=lambda m: m["batch"])

    def _parts(self, what: str) -> DataFrame | None:
        paths = [f"{self.top}/{m['folder']}/{what}" for m in self.batches()]
        return self.spark.read.parquet(*paths) if paths else None

    def pending(self, sessions: DataFrame, limit: int | None = None) -> DataFrame:
        """The first `limit` sessions by their id (all, if none), without those that are committed."""
        some = sessions.orderBy("session_id").limit(limit) if limit else sessions
        done = self._parts("sessions")
        return some if done is None else some.join(done.select("session_id"), "session_id", "left_anti")

    def go(self, sessions: DataFrame, limit: int | None = None, stop_before: str | None = None) -> dict:
        """One batch of all that is pending, committed at its end. stop_before names a phase before which the run ends
        as if it were lost."""
        number = max((m["batch"] for m in self.batches()), default=-1) + 1
        folder = f"batch-{number}-{uuid.uuid4().hex}"
        self.pending(sessions, limit).write.parquet(f"{self.top}/{folder}/sessions")
        rows = self.spark.read.parquet(f"{self.top}/{folder}/sessions")
        for name, phase in self.phases:
            if name == stop_before:
                raise RuntimeError(f"stopped before {name}")
            rows = phase(rows)
        rows.write.parquet(f"{self.top}/{folder}/rows")
        told = {"batch": number, "folder": folder, "phases": [n for n, _ in self.phases]}
        self.files.publish(f"{self.top}/manifest/{number}.json", json.dumps(told))
        return told

    def result(self) -> DataFrame:
        return self._parts("rows")
