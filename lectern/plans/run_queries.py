"""The segment post-processor and a run in phases, on the transcript view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.operators import runs
from lectern.sources.segments import SEGMENTS_SQL, segments
from lectern.sources.stores import shared_folder

#: What follows a raw name, by position.
AFTER = ["", " (PPE). –", ":", ". – and more"]
_after = "CASE (session_id + seq) % 4 " + " ".join(f"WHEN {k} THEN '{a}'" for k, a in enumerate(AFTER)) + " END"
_html = "concat('<p>', coalesce(text, ''), '</p><script>no()</script> &amp;nbsp; ', CASE WHEN seq % 3 = 0 THEN '&lt;end&gt;' ELSE '' END)"
_fields = {"speaker": f"concat(speaker, {_after})", "text": _html, "confidence": "CASE WHEN seq % 9 = 4 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END", "role": "CASE WHEN seq % 5 = 1 THEN 'Vice-President of the house' WHEN seq % 5 = 2 THEN 'member' END"}


def raw_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select("session_id", "seq", *(F.expr(e).alias(c) for c, e in _fields.items()))


RAW = f"SELECT session_id, seq, {', '.join(f'{e} AS {c}' for c, e in _fields.items())} FROM ({SEGMENTS_SQL})"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _clean(x: str) -> str:
    out = rf"regexp_replace(regexp_replace({x}, '(?is)<(script|style)\b[^>]*>.*?</(?:script|style)\s*>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
    for entity, char in runs.ENTITIES.items():
        out = f"replace({out}, '{entity.replace(chr(39), chr(39) * 2)}', '{char.replace(chr(39), chr(39) * 2)}')"
    return _strip(rf"regexp_replace({out}, '\s+', ' ', 'g')")


_found = "coalesce(" + ", ".join("nullif(" + _strip(f"regexp_extract({_strip('speaker')}, '{p}', 1)") + ", '')" for p in R.SPEAKER_PREFIXES) + ")"
_name = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(found, '(?i)\b(Mr|Mrs|Ms|Miss|Dr|Prof|President|Vice-President|Commissioner|Minister)\b\.?\s*', '', 'g'), '\([^)]*\)', '', 'g'), '[^\w\s''-]', ' ', 'g'), '\s+', ' ', 'g'))"
ENHANCED = f"""WITH r AS ({RAW}), f AS (SELECT *, {_found} AS found FROM r),
n AS (SELECT session_id, seq, CASE WHEN found IS NULL THEN speaker ELSE {_name} END AS speaker, {_clean('text')} AS text, confidence, role, true AS enhanced FROM f)
SELECT session_id, seq, speaker, text, confidence, role, enhanced FROM n WHERE length(speaker) >= 2 AND length(text) >= 10 AND confidence >= 0.1"""


def t44_enhanced_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.enhanced(raw_segments(spark, sf_dir), confidence="confidence")


def phases(spark: SparkSession, sf_dir: str) -> list[tuple[str, runs.Phase]]:
    raw = raw_segments(spark, sf_dir)
    return [
        ("collect", lambda sessions: raw.join(sessions.select("session_id"), "session_id", "left_semi")),
        ("enhance", lambda rows: runs.enhanced(rows, confidence="confidence")),
        ("classify", lambda rows: rows.withColumn("is_announcement", runs.simple_announcement(F.col("text"), F.col("role")))),
        ("validate", lambda rows: rows.withColumn("valid", F.col("role").isNotNull() & (F.length("text") <= 50_000))),
        ("output", lambda rows: rows.select("session_id", "seq", F.col("speaker").alias("speaker_name"), F.col("text").alias("speech_text"), "is_announcement", "valid")),
    ]


def t45_phased_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the first sessions, one that is lost on its way, and one that goes on with what is left."""
    run = runs.Run(spark, shared_folder(spark, "run"), phases(spark, sf_dir))
    sessions = segments(spark, sf_dir).select("session_id").distinct()
    run.go(sessions, limit=40)
    try:
        run.go(sessions, stop_before="validate")
    except RuntimeError:
        run.go(sessions)
    return run.result()


_said = " OR ".join([f"contains(lower(coalesce(role, '')), '{r}')" for r in R.SIMPLE_ROLES] + [f"regexp_matches(lower(text), '{p}')" for p in R.SIMPLE_ANNOUNCEMENTS])
T45 = rf"""SELECT session_id, seq, speaker AS speaker_name, text AS speech_text, len(regexp_extract_all(text, '\S+')) < 20 OR {_said} AS is_announcement,
  role IS NOT NULL AND length(text) <= 50000 AS valid FROM ({ENHANCED})"""

PAIRS = {"t44_enhanced_segments": (t44_enhanced_segments, ENHANCED), "t45_phased_run": (t45_phased_run, T45)}
