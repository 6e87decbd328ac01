"""Queries on time mentions, and their SQL.

Every document begins with a phrase that holds a mention, so that each pattern, confidence and event has rows; what the
texts themselves hold is found as well. The SQL finds places by splitting a text at each pattern and adding lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.operators import mentions as M

PHRASES = [
    "The sitting opens at 09:15:30 in the hall.", "Session resumed, 14.05.59 by the clock; Mr President. – the sitting goes on.", "Madam President. – The debate of 10:45 continues.",
    "Commissioner Vella. – We met, 16.20, and the speaker begins.", "La séance est ouverte, 15h30, dans la salle.", "The vote begins at 11:05:07 pm, after the break.", "Voting, 12:30:15 a.m.x was noted.",
    "A recess until 3:40 PM and then the ballot.", "Adjourned: 12:05 p.m.y resume later.", "The vote at 14 hours and 30 minutes, then lunch at 9.", "The session ends around 18:45 or about 19, it is said.",
    "We break for lunch half past 12 and resume 20 minutes past 13.", "The sitting closes; applause lasting until 25:10 and 7:75, 23:59.",
    "After the break, 08:05, all were seated.",
]
SPEAKERS = ["Mr President", "Commissioner Vella", "", "the sitting chair"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (F.col("doc_id") % len(PHRASES)).cast("int") + 1)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.concat(phrase, F.lit("\n"), F.coalesce("text", F.lit(""))).alias("text"))


def _quoted(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


DOCUMENTS = f"SELECT doc_id, {_quoted(PHRASES)}[doc_id % {len(PHRASES)} + 1] || chr(10) || coalesce(text, '') AS text FROM documents"


def told(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mentions(documents(spark, sf_dir))


def _branch(k: int, kind: str, worth: float, pattern: str) -> str:
    p = "'(?i)" + pattern + "'"
    marked = kind.endswith("ampm")
    own = "m || 'x'" if "A\\.M" in pattern else "m"  # what ends with a full stop is a match only before a word
    seconds = f"coalesce(try_cast(regexp_extract({own}, {p}, 3) AS INT), 0)" if "ss" in kind else "0"
    half = f"upper(regexp_extract({own}, {p}, {4 if 'ss' in kind else 3}))" if marked else "''"
    minute = f"coalesce(try_cast(regexp_extract({own}, {p}, 2) AS INT), 0)" if k < len(R.MENTION_PATTERNS) - 1 else "0"
    return f"""SELECT doc_id, text, {k} AS pattern, '{kind}' AS format, {worth}::DOUBLE AS worth, m, start, regexp_extract({own}, {p}, 1)::INT AS h, {minute} AS mi, {seconds} AS s, {half} AS half
  FROM (SELECT doc_id, text, hits[i] AS m, coalesce(list_sum([length(x) for x in parts[1:i]]), 0) + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0) AS start
    FROM (SELECT doc_id, text, string_split_regex(text, {p}) AS parts, regexp_extract_all(text, {p}, 0) AS hits FROM d), unnest(range(1, len(hits) + 1)) AS u(i))"""


def _any(patterns: list[str], x: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, '{p}')" for p in patterns) + ")"


def _words(words: list[str], x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def _event() -> str:
    arms = []
    for words, also, event, other in R.TIME_EVENTS:
        then = f"CASE WHEN {_words(also, 'whole')} THEN '{event}' ELSE '{other}' END" if also else f"'{event}'"
        arms.append(f"WHEN {_words(words, 'whole')} THEN {then}")
    return f"CASE {' '.join(arms)} ELSE '{R.OTHER_EVENT}' END"


_boost = " + ".join([f"CASE WHEN {_any(R.PARLIAMENT_TIMES, 'near')} THEN 0.15::DOUBLE ELSE 0 END", *[f"CASE WHEN {_any(p, 'near')} THEN 0.1::DOUBLE ELSE 0 END" for p in R.TIME_CONTEXTS.values()]])
MENTIONS = f"""
WITH d AS ({DOCUMENTS}),
a AS ({" UNION ALL ".join(_branch(k, *x) for k, x in enumerate(R.MENTION_PATTERNS))}),
b AS (SELECT *, CASE WHEN half IN ('PM', 'P.M.') AND h < 12 THEN h + 12 WHEN half IN ('AM', 'A.M.') AND h = 12 THEN 0 ELSE h END AS hour, start + length(m) AS stop,
    substr(text, (greatest(start - 50, 0) + 1)::BIGINT, least(start, 50)::BIGINT) AS before, substr(text, (start + length(m) + 1)::BIGINT, 50) AS after FROM a),
c AS (SELECT *, hour * 3600 + mi * 60 + s AS seconds, lower(before || ' ' || after) AS near, lower(before || ' ' || m || ' ' || after) AS whole FROM b WHERE hour <= 23 AND mi <= 59 AND s <= 59),
e AS (SELECT *, least(1.0::DOUBLE, worth + ({_boost})) AS sure FROM c)
SELECT doc_id, pattern, format, start::BIGINT AS start, stop::BIGINT AS stop, m AS match, seconds, sure,
  CASE WHEN sure >= 0.9 THEN 'high' WHEN sure >= 0.7 THEN 'medium' WHEN sure >= 0.5 THEN 'low' ELSE 'estimated' END AS confidence, {_event()} AS event,
  regexp_replace(before, '^\\s+|\\s+$', '', 'g') AS context_before, regexp_replace(after, '^\\s+|\\s+$', '', 'g') AS context_after FROM e"""

ONCE = f"""SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, seconds, start // 100 ORDER BY start, pattern) AS k FROM ({MENTIONS})) WHERE k = 1"""


def speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A speech for each line of a document's first lines, with its place."""
    lines = documents(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "own"))
    from pyspark.sql import Window as W

    before = F.coalesce(F.sum(F.length("own") + 1).over(W.partitionBy("doc_id").orderBy("line").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return lines.select("doc_id", before.cast("long").alias("speech_start"), F.element_at(F.array(*map(F.lit, SPEAKERS)), (F.col("line") + F.col("doc_id")).cast("int") % len(SPEAKERS) + 1).alias("speaker"))


SPEECHES = f"""SELECT doc_id, coalesce(sum(length(own) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS speech_start,
  {_quoted(SPEAKERS)}[(line + doc_id) % {len(SPEAKERS)} + 1] AS speaker
  FROM (SELECT doc_id, lines[i] AS own, i - 1 AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM ({DOCUMENTS})), unnest(range(1, len(lines) + 1)) AS u(i))"""


def w14_mention_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.without_repeats(told(spark, sf_dir)).select("doc_id", "pattern", "start", "seconds", "event")


def j10_near_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.associated(speeches(spark, sf_dir), M.without_repeats(told(spark, sf_dir)))
    return out.select("doc_id", "speech_start", "speaker", "seconds", "mention_start", "timing", F.round("score", 9).alias("score"))


J10 = f"""
WITH s AS ({SPEECHES}), t AS ({ONCE}),
u AS (SELECT *, CASE confidence WHEN 'high' THEN 0.95 WHEN 'medium' THEN 0.8 WHEN 'low' THEN 0.6 ELSE 0.3 END::DOUBLE AS timing, lower(context_before || ' ' || context_after) AS near FROM t),
m AS (SELECT s.doc_id, s.speech_start, u.seconds, u.start AS mention_start, u.pattern, u.timing,
    (1.0::DOUBLE - abs(u.start - s.speech_start) / 200.0::DOUBLE) * 0.4::DOUBLE + u.timing * 0.3::DOUBLE
    + CASE WHEN len(list_filter(list_filter(string_split_regex(lower(s.speaker), '\\s+'), lambda w: w <> '')[1:3], lambda w: contains(u.near, w))) > 0 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN u.event = 'speech_start' THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END AS score
  FROM s JOIN u ON s.doc_id = u.doc_id AND abs(u.start - s.speech_start) <= 200),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, speech_start ORDER BY score DESC, mention_start, pattern) AS k FROM m) WHERE k = 1)
SELECT s.doc_id, s.speech_start, s.speaker, b.seconds, b.mention_start, b.timing, round(b.score, 9) AS score
FROM s LEFT JOIN b ON s.doc_id = b.doc_id AND s.speech_start = b.speech_start"""


def _of(*columns: str):
    return lambda spark, sf_dir: told(spark, sf_dir).select("doc_id", "pattern", "start", *columns), f"SELECT doc_id, pattern, start, {', '.join(columns)} FROM ({MENTIONS})"


PAIRS = {
    "d7_time_mentions": _of("stop", "match", "context_before", "context_after"),
    "d8_mention_time": _of("format", "seconds"),
    "d9_mention_confidence": _of("sure", "confidence"),
    "d10_event_type": _of("event"),
    "w14_mention_dedup": (w14_mention_dedup, f"SELECT doc_id, pattern, start, seconds, event FROM ({ONCE})"),
    "j10_near_marks": (j10_near_marks, J10),
}
