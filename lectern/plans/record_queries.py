"""Registered queries on output records: validation of all fields, speaker prefixes, dates and the output projection."""

from __future__ import annotations

from lectern.functions import rules as R
from lectern.functions.dialect import Spark, strip
from lectern.operators import transcript as T
from lectern.plans.relational_queries import statement
from lectern.plans.transcript_queries import _projection

# fixed values: names that count as countries and groups besides the dictionaries
COUNTRIES = ["Germany", "France", "Spain", "N/A", "Council"]
GROUPS = ["PPE", "SD", "GRN", "NI"]


def _list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def record(d: Spark) -> list[dict[str, str]]:
    """The output record of a segment, with gaps and faults by position."""
    null = "cast(null as string)" if d.name == "spark" else "cast(null as varchar)"
    return [
        {
            "speaker_name": f"CASE WHEN seq % 11 = 0 THEN {null} ELSE speaker END",
            "speaker_country": f"CASE WHEN seq % 7 = 3 THEN 'Atlantis' WHEN seq % 7 = 5 THEN {null} ELSE 'France' END",
            "speaker_party_or_group": "CASE WHEN seq % 5 = 2 THEN 'Unknown' ELSE 'PPE' END",
            "start_s": "seq * 60",
            "end_s": "seq * 60 + CASE WHEN session_id % 9 = 0 THEN 0 WHEN session_id % 9 = 1 THEN 4000 ELSE 50 END",
            "speech_text": "text",
            "is_announcement": "session_id % 3 = 0",
            "announcement_label": f"CASE WHEN seq % 2 = 0 THEN 'agenda_item' ELSE {null} END",
        }
    ]


def record_validation(d: Spark) -> list[dict[str, str]]:
    """issues, warnings, score and validity of a record by its eight fields."""
    name_bad = "speaker_name IS NULL OR length(trim(speaker_name)) < 2"
    text_bad = "length(trim(speech_text)) < 10"
    nulls = ["speaker_name", "speaker_country", "announcement_label"]
    issues = [f"CASE WHEN {c} IS NULL THEN 'null_field_{c}' END" for c in nulls] + [
        f"CASE WHEN {name_bad} THEN 'invalid_speaker_name' END", "CASE WHEN end_s <= start_s THEN 'negative_duration' END",
        f"CASE WHEN {text_bad} THEN 'insufficient_speech_text' END", "CASE WHEN is_announcement AND announcement_label IS NULL THEN 'missing_announcement_label' END",
    ]
    warnings = [
        "CASE WHEN length(speaker_name) > 200 THEN 'very_long_speaker_name' END", f"CASE WHEN speaker_country NOT IN {_list(COUNTRIES)} THEN 'unrecognized_country' END",
        f"CASE WHEN speaker_party_or_group NOT IN {_list(GROUPS)} THEN 'unrecognized_political_group' END", "CASE WHEN end_s - start_s > 3600 THEN 'very_long_speech' END",
        "CASE WHEN length(speech_text) > 50000 THEN 'very_long_speech_text' END", "CASE WHEN NOT is_announcement AND announcement_label IS NOT NULL THEN 'unexpected_announcement_label' END",
    ]
    fields = " + ".join([
        f"CASE WHEN {name_bad} THEN 0.0D WHEN length(speaker_name) > 200 THEN 0.8D ELSE 1.0D END",
        f"CASE WHEN speaker_country IS NULL THEN 0.0D WHEN speaker_country NOT IN {_list(COUNTRIES)} THEN 0.7D ELSE 1.0D END",
        "4.0D", f"CASE WHEN {text_bad} THEN 0.0D ELSE 1.0D END", "CASE WHEN announcement_label IS NULL THEN 0.0D ELSE 1.0D END",
    ])
    count = lambda arms: " + ".join(f"CASE WHEN ({a}) IS NULL THEN 0 ELSE 1 END" for a in arms)
    return [
        *record(d),
        {"issues": d.joined(issues, ","), "warnings": d.joined(warnings, ","), "n_issues": count(issues), "n_warnings": count(warnings), "fields": fields},
        {"score": "round(greatest(0.0D, (fields) / 8.0D - n_issues * 0.1D - n_warnings * 0.05D), 9)"},
        {"valid_record": "score > 0.8D AND n_issues = 0"},
    ]


def output_projection(d: Spark) -> list[dict[str, str]]:
    kind = "string" if d.name == "spark" else "varchar"
    return [*record(d), {f"out_{c}": f"coalesce(cast({c} as {kind}), '')" for c in ("speaker_name", "speaker_country", "speaker_party_or_group", "speech_text", "is_announcement", "announcement_label")}]


def speaker_prefix(d: Spark) -> list[dict[str, str]]:
    """Name and role before a speech, by the first of four patterns that gives a name."""
    patterns = R.SPEAKER_PREFIXES
    names = [f"nullif({strip(d, d.ext('text', p, 1))}, '')" for p in patterns]
    roles = [f"nullif({strip(d, d.ext('text', p, 2))}, '')" for p in patterns[:2]]
    return [{f"p{i}": n for i, n in enumerate(names)}, {"prefix_name": "coalesce(p0, p1, p2, p3)", "prefix_role": f"CASE WHEN p0 IS NOT NULL THEN {roles[0]} WHEN p1 IS NOT NULL THEN {roles[1]} END"}]


def without_markers(d: Spark) -> list[dict[str, str]]:
    marked = d.rep("text", r"(?i)\((?:laughter|interruption|mixed reactions)\)|\([^)]*applause[^)]*\)", " ")
    return [{"speech": strip(d, d.rep(marked, r"\s+", " "))}]


def seconds_of_day(d: Spark) -> list[dict[str, str]]:
    hour, minute = "cast(split_part(hint, ':', 1) as int)", "cast(split_part(hint, ':', 2) as int)"
    return [*T.time_hint(d), {"seconds": f"CASE WHEN {hour} BETWEEN 0 AND 23 AND {minute} BETWEEN 0 AND 59 THEN {hour} * 3600 + {minute} * 60 END"}]


def processor_filter(d: Spark) -> list[dict[str, str]]:
    return [*T.parsed(d), {"processed": "length(coalesce(who, speaker)) >= 2 AND length(coalesce(rest, text)) >= 10 AND coalesce(confidence, 0.5D) >= 0.1D"}]


DATES = "CASE o_orderkey % 5 WHEN 0 THEN '2024-01-15' WHEN 1 THEN '15/01/2024' WHEN 2 THEN '15.01.2024' WHEN 3 THEN '20240115' ELSE 'soon' END"
PAIRS = {
    "t3_speaker_prefix": _projection(speaker_prefix, ["prefix_name", "prefix_role"]),
    "t4_speech_text": _projection(without_markers, ["speech"]),
    "t21_record_validation": _projection(record_validation, ["issues", "warnings", "score", "valid_record"]),
    "s15_output_projection": _projection(output_projection, ["out_speaker_name", "out_speaker_country", "out_speaker_party_or_group", "out_speech_text", "out_is_announcement", "out_announcement_label"]),
    "f6_processor_filter": _projection(processor_filter, ["processed"]),
    "d1_seconds_of_day": _projection(seconds_of_day, ["seconds"]),
    "d2_iso_format": statement("SELECT o_orderkey, date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS iso FROM {orders}", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM orders"),
    "d11_timeline_quality": statement("SELECT user_id, round(least(1.0E0, cov / 0.3E0) * 0.4E0 + compl * 0.3E0 + 0.15E0, 9) AS quality FROM (SELECT user_id, count(CASE WHEN value > 50 THEN 1 END) * 1.0E0 / count(*) AS cov, count(DISTINCT event_type) / 5.0E0 AS compl FROM {events} GROUP BY user_id)"),
}
