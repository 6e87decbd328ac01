"""Registered queries over the transcript view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import transcript as T
from lectern.plans.layers import applied, written
from lectern.sources.segments import SEGMENTS_SQL, segments

KEY = ["session_id", "seq"]


def _projection(layers, columns):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return applied(segments(spark, sf_dir), layers).select(*KEY, *columns)

    return run, f"SELECT {', '.join([*KEY, *columns])} FROM ({written(SEGMENTS_SQL, layers)})"


def _grouped(layers, by: list[str], measures: dict[str, tuple[str, str]]):
    """measures: name -> (Spark expression, DuckDB expression)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = applied(segments(spark, sf_dir), layers)
        aggs = [F.expr(s).alias(n) for n, (s, _) in measures.items()]
        return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)

    sql = f"SELECT {', '.join([*by, *(f'{x} AS {n}' for n, (_, x) in measures.items())])} FROM ({written(SEGMENTS_SQL, layers)})"
    return run, sql + (f" GROUP BY {', '.join(by)}" if by else "")


def _same(**e: str) -> dict[str, tuple[str, str]]:
    return {n: (x, x) for n, x in e.items()}


def _checked(d):
    return [*T.text_quality(d), *T.parsed(d), *T.classified(d), *T.segment_issues(d)]


def _speech_stats(d):
    return [*T.parsed(d)]


COUNTS = _same(n="count(*)", high="count(CASE WHEN context_confidence >= 0.8 THEN 1 END)", low="count(CASE WHEN context_confidence < 0.5 THEN 1 END)")
_SESSION = "(PARTITION BY session_id ORDER BY seq)"


def _hints(d):
    """Backwards times and gaps over eight hours between rows that have a time."""
    minutes = "cast(split_part(hint, ':', 1) as int) * 60 + cast(split_part(hint, ':', 2) as int)"
    return [*T.time_hint(d), {"minutes": f"CASE WHEN hint IS NOT NULL THEN {minutes} END"}]


def w8_hint_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = applied(segments(spark, sf_dir), _hints).where("minutes IS NOT NULL")
    df = df.withColumn("previous", F.expr(f"lag(minutes) OVER {_SESSION}"))
    return df.select(*KEY, "minutes", F.expr("minutes < previous").alias("backwards"), F.expr("minutes - previous > 480").alias("gap"))


W8_SQL = f"SELECT session_id, seq, minutes, minutes < p AS backwards, minutes - p > 480 AS gap FROM (SELECT *, lag(minutes) OVER {_SESSION} AS p FROM ({written(SEGMENTS_SQL, _hints)}) WHERE minutes IS NOT NULL)"


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments from lines: a speaker line opens one, later lines join it unless the head is procedural or the line
    looks like a new speaker; the last time seen is carried forward. One sort per session, no Python."""
    df = applied(segments(spark, sf_dir), T.parsed)
    df = df.withColumns(
        {
            "segment": F.expr(f"sum(CASE WHEN who IS NOT NULL THEN 1 ELSE 0 END) OVER {_SESSION}"),
            "carried": F.expr(f"last_value(hint, true) OVER {_SESSION}"),
        }
    ).where("segment > 0")
    df = df.withColumn("head_procedural", F.expr("first_value(procedural) OVER (PARTITION BY session_id, segment ORDER BY seq)"))
    df = df.where("who IS NOT NULL OR (NOT head_procedural AND NOT new_speaker AND text <> '')")
    # the parts of a segment are few lines of one session; their order is kept in the array
    return df.groupBy("session_id", "segment").agg(
        F.expr("max(who)").alias("speaker"),
        F.expr("array_join(transform(array_sort(collect_list(struct(seq, coalesce(rest, text) AS t))), x -> x.t), ' ')").alias("text"),
        F.expr("coalesce(min_by(CASE WHEN who IS NOT NULL THEN carried END, seq), min_by(hint, CASE WHEN hint IS NOT NULL THEN seq END))").alias("hint"),
        F.expr("bool_or(who IS NOT NULL AND procedural)").alias("procedural"),
        F.expr("CASE WHEN count(*) > 1 THEN least(max(confidence), 0.7D) ELSE max(confidence) END").alias("confidence"),
    )


ASSEMBLED_SQL = f"""
WITH p AS (SELECT *, sum(CASE WHEN who IS NOT NULL THEN 1 ELSE 0 END) OVER {_SESSION} AS segment,
    last_value(hint IGNORE NULLS) OVER {_SESSION} AS carried FROM ({written(SEGMENTS_SQL, T.parsed)})),
h AS (SELECT *, first_value(procedural) OVER (PARTITION BY session_id, segment ORDER BY seq) AS hp FROM p WHERE segment > 0)
SELECT session_id, segment::BIGINT AS segment, max(who) AS speaker, string_agg(coalesce(rest, text), ' ' ORDER BY seq) AS text,
  coalesce(max(carried) FILTER (who IS NOT NULL), arg_min(hint, seq) FILTER (hint IS NOT NULL)) AS hint,
  bool_or(who IS NOT NULL AND procedural) AS procedural, CASE WHEN count(*) > 1 THEN least(max(confidence), 0.7) ELSE max(confidence) END AS confidence
FROM h WHERE who IS NOT NULL OR (NOT hp AND NOT new_speaker AND text <> '') GROUP BY session_id, segment"""


def w3_pair_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring short procedural segments merge in pairs from the left, unless two sure speakers differ."""
    df = _assembled(spark, sf_dir)
    w = "(PARTITION BY session_id ORDER BY segment)"
    short = "procedural AND size(filter(split(text, r'\\s+'), x -> x <> '')) < 5"
    pair = f"lag(short) OVER {w} AND short AND NOT (lag(speaker) OVER {w} <> speaker AND lag(confidence) OVER {w} > 0.7 AND confidence > 0.7)"
    df = df.withColumn("short", F.expr(short)).withColumn("joins", F.expr(f"coalesce({pair}, false)"))
    df = df.withColumn("run", F.expr(f"sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER {w}"))
    df = df.withColumn("k", F.expr("row_number() OVER (PARTITION BY session_id, run ORDER BY segment) - 1"))
    merged = df.groupBy("session_id", "run", F.expr("cast(floor(k / 2) as int)").alias("pair")).agg(
        F.min("segment").alias("segment"), F.expr("min_by(speaker, segment)").alias("speaker"), F.count("*").alias("parts"), F.min("confidence").alias("confidence")
    )
    return merged.withColumn("number", F.expr("cast(row_number() OVER (PARTITION BY session_id ORDER BY segment) as bigint)")).select("session_id", "number", "speaker", "parts", "confidence")


W3_SQL = f"""
WITH a AS (SELECT *, procedural AND len(regexp_extract_all(text, '\\S+')) < 5 AS short FROM ({ASSEMBLED_SQL})),
j AS (SELECT *, coalesce(lag(short) OVER w AND short AND NOT (lag(speaker) OVER w <> speaker AND lag(confidence) OVER w > 0.7 AND confidence > 0.7), false) AS joins FROM a WINDOW w AS (PARTITION BY session_id ORDER BY segment)),
r AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY segment) AS run FROM j),
k AS (SELECT *, (row_number() OVER (PARTITION BY session_id, run ORDER BY segment) - 1) // 2 AS pair FROM r),
m AS (SELECT session_id, min(segment) AS segment, arg_min(speaker, segment) AS speaker, count(*) AS parts, min(confidence) AS confidence FROM k GROUP BY session_id, run, pair)
SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY segment) AS number, speaker, parts, confidence FROM m"""


def w10_single_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = segments(spark, sf_dir).withColumn("n", F.expr("count(*) OVER (PARTITION BY session_id, lower(speaker))")).withColumn("of", F.expr("count(*) OVER (PARTITION BY session_id)"))
    return df.where("n = 1 AND of > 3 AND NOT contains(lower(speaker), 'president') AND NOT contains(lower(speaker), 'commissioner')").select(*KEY, "speaker")


W10_SQL = f"SELECT session_id, seq, speaker FROM (SELECT *, count(*) OVER (PARTITION BY session_id, lower(speaker)) AS n, count(*) OVER (PARTITION BY session_id) AS o FROM ({SEGMENTS_SQL})) WHERE n = 1 AND o > 3 AND lower(speaker) NOT LIKE '%president%' AND lower(speaker) NOT LIKE '%commissioner%'"


def w5_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts by the last explicit time and the lengths spoken since, five seconds between speeches."""
    df = applied(segments(spark, sf_dir), _timed).withColumn("grp", F.expr(f"count(explicit) OVER {_SESSION}"))
    since = "(PARTITION BY session_id, grp ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    start = f"coalesce(first_value(explicit) OVER (PARTITION BY session_id, grp ORDER BY seq), 32400.0D) + coalesce(sum(seconds + 5.0D) OVER {since}, 0.0D)"
    return df.withColumn("start", F.expr(start)).select(*KEY, "start", F.expr("start + seconds").alias("end"))


def _timed(d):
    words = d.words("text")
    minutes = "cast(split_part(hint, ':', 1) as int) * 60 + cast(split_part(hint, ':', 2) as int)"
    return [*T.time_hint(d), {"seconds": f"greatest({words} / 150.0D * 60.0D, 30.0D)", "explicit": f"CASE WHEN hint IS NOT NULL THEN ({minutes}) * 60.0D END"}]


W5_SQL = f"""SELECT session_id, seq, start, start + seconds AS "end" FROM (
  SELECT *, coalesce(first_value(explicit) OVER (PARTITION BY session_id, grp ORDER BY seq), 32400.0) + coalesce(sum(seconds + 5.0) OVER (PARTITION BY session_id, grp ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS start
  FROM (SELECT *, count(explicit) OVER {_SESSION} AS grp FROM ({written(SEGMENTS_SQL, _timed)})))"""


def w6_sequence_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = w5_interpolated(spark, sf_dir)
    last = "last_value(end, true) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return df.select(*KEY, F.expr("end - start > 3600").alias("too_long"), F.expr(f"coalesce(start < {last}, false)").alias("overlaps"))


W6_SQL = f"""SELECT session_id, seq, "end" - start > 3600 AS too_long,
  coalesce(start < last_value("end" IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS overlaps FROM ({W5_SQL})"""


def w13_speaker_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = applied(segments(spark, sf_dir), _run_layers)
    w = "(PARTITION BY session_id ORDER BY seq)"
    df = df.withColumn("starts", F.expr(f"NOT coalesce(name = lag(name) OVER {w} AND sure >= 0.6D AND lag(sure) OVER {w} >= 0.6D, false)"))
    df = df.withColumn("run", F.expr(f"sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER {w}"))
    return df.groupBy("session_id", "run").agg(F.min("seq").alias("first_seq"), F.count("*").alias("parts"), F.max("name").alias("name"))


def _run_layers(d):
    return [{"name": "CASE WHEN seq % 4 < 2 THEN 'A' ELSE 'B' END", "sure": "CASE WHEN seq % 5 = 0 THEN 0.5D ELSE 0.9D END"}]


W13_SQL = f"""SELECT session_id, run::BIGINT AS run, min(seq) AS first_seq, count(*) AS parts, max(name) AS name FROM (
  SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY seq) AS run FROM (
    SELECT *, NOT coalesce(name = lag(name) OVER w AND sure >= 0.6 AND lag(sure) OVER w >= 0.6, false) AS starts
    FROM ({written(SEGMENTS_SQL, _run_layers)}) WINDOW w AS (PARTITION BY session_id ORDER BY seq))) GROUP BY session_id, run"""


def a3_batch_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = applied(segments(spark, sf_dir), _checked)
    g = df.groupBy("session_id").agg(
        F.avg("validation_score").alias("avg_score"), F.count("*").alias("n"), F.count_if(F.expr("validation_score >= 0.5 AND n_critical = 0")).alias("passed"),
        F.count_if(F.expr("n_high > 0")).alias("with_high"), F.count_if(F.expr("n_critical > 0")).alias("with_critical"),
    )
    return g.withColumn("valid", F.expr("passed >= n * 0.8D"))


A3_SQL = f"""SELECT *, passed >= n * 0.8 AS valid FROM (SELECT session_id, avg(validation_score) AS avg_score, count(*) AS n,
  count(*) FILTER (validation_score >= 0.5 AND n_critical = 0) AS passed, count(*) FILTER (n_high > 0) AS with_high, count(*) FILTER (n_critical > 0) AS with_critical
  FROM ({written(SEGMENTS_SQL, _checked)}) GROUP BY session_id)"""


def a4_issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # filtered after the explode: a filter below it would evaluate every rule again
    df = applied(segments(spark, sf_dir), _checked).select(F.explode(F.split("issue_list", ",")).alias("i")).where("i <> ''")
    return df.select(F.split("i", ":")[0].alias("category"), F.split("i", ":")[1].alias("severity")).groupBy("category", "severity").agg(F.count("*").alias("n"))


A4_SQL = f"SELECT split_part(i, ':', 1) AS category, split_part(i, ':', 2) AS severity, count(*) AS n FROM (SELECT unnest(string_split(issue_list, ',')) AS i FROM ({written(SEGMENTS_SQL, _checked)}) WHERE issue_list <> '') GROUP BY 1, 2"


def _scored(d):
    return [*T.parsed(d), *T.segment_score(d, "coalesce(who, speaker)", "coalesce(rest, text)", "coalesce(confidence, 0.5D)")]


def _context(d):
    return [*T.classified(d), *T.in_context(d)]


PAIRS = {
    "t5_procedural_text": _projection(T.plain_procedural, ["is_procedural"]),
    "t6_timestamp_hint": _projection(T.plain_timestamp, ["hint"]),
    "t7_announcement_type": _projection(T.plain_announcement, ["announcement"]),
    "t8_text_quality": _projection(T.text_quality, ["n_chars", "n_words", "issues", "quality", "is_valid"]),
    "t9_speaker_match": _projection(T.speaker_match, ["who", "rest", "party", "pattern_index"]),
    "t10_procedural_line": _projection(lambda d: [*T.speaker_match(d), *T.procedural_line(d)], ["procedural"]),
    "t11_time_hint": _projection(T.time_hint, ["hint"]),
    "t12_parse_confidence": _projection(T.parsed, ["confidence"]),
    "t13_new_speaker": _projection(T.parsed, ["new_speaker"]),
    "t14_segment_score": _projection(_scored, ["segment_score", "accepted"]),
    "t15_features": _projection(T.features, ["features"]),
    "t16_rule_classifier": _projection(T.classified, ["content_type", "class_confidence"]),
    "t17_announcement_subtype": _projection(T.classified, ["content_type", "announcement_type"]),
    "t18_reasoning": _projection(T.classified, ["reasoning"]),
    "t19_segment_issues": _projection(_checked, ["issue_list", "n_critical", "n_high", "n_medium", "n_low"]),
    "t20_validation_score": _projection(_checked, ["validation_score"]),
    "f5_accepted_segments": _grouped(_scored, ["session_id"], _same(n="count(*)", accepted="count(CASE WHEN accepted THEN 1 END)")),
    "w1_segment_assembly": (_assembled, ASSEMBLED_SQL),
    "w3_pair_merge": (w3_pair_merge, W3_SQL),
    "w5_interpolated_times": (w5_interpolated, W5_SQL),
    "w6_sequence_checks": (w6_sequence_checks, W6_SQL),
    "w7_context_confidence": _projection(_context, ["context_confidence"]),
    "w8_hint_order": (w8_hint_order, W8_SQL),
    "w10_single_speakers": (w10_single_speakers, W10_SQL),
    "w13_speaker_runs": (w13_speaker_runs, W13_SQL),
    "a1_parsing_stats": _grouped(T.parsed, [], _same(lines="count(*)", heads="count(who)", procedural="count(CASE WHEN procedural THEN 1 END)", avg_confidence="avg(confidence)", sure="count(CASE WHEN confidence >= 0.8 THEN 1 END)", timed="count(hint)")),
    "a2_classification_stats": _grouped(_context, ["content_type"], COUNTS | _same(avg_confidence="round(avg(context_confidence), 6)")),
    "a3_batch_validation": (a3_batch_validation, A3_SQL),
    "a4_issue_counts": (a4_issue_counts, A4_SQL),
}
