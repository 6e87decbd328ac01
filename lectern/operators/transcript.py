"""Rules over transcript segments (session_id, seq, speaker, text), as layers of expressions.

All are projections: one pass, no shuffle, evaluated by the JVM. Functions take a dialect and return layers.
"""

from __future__ import annotations

from lectern.functions import rules as R
from lectern.functions.dialect import Spark, case, strip, total

Layer = list[dict[str, str]]


def _any(d: Spark, x: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(d.has(x, p) for p in phrases) + ")"


# ---- plain text functions ---------------------------------------------------------------------------


def plain_procedural(d: Spark) -> Layer:
    return [{"is_procedural": f"(length({strip(d, 'text')}) < 10 OR {_any(d, 'lower(text)', R.PROCEDURAL_PHRASES)})"}]


def plain_timestamp(d: Spark) -> Layer:
    tries = [f"nullif({d.ext('text', '(?i)' + p, 1)}, '')" for p in R.PLAIN_TIMES]
    return [{"hint": f"replace(coalesce({', '.join(tries)}), 'h', ':')"}]


def plain_announcement(d: Spark) -> Layer:
    arms = [(_any(d, "lower(text)", phrases), f"'{kind}'") for kind, phrases in R.ANNOUNCEMENT_PHRASES.items()]
    arms.append((d.has("lower(speaker)", "president"), "'session_management'"))
    arms.append((f"{d.words('text')} < 20", "'general_announcement'"))
    return [{"announcement": case(arms)}]


def text_quality(d: Spark, x: str = "text") -> Layer:
    every = f"regexp_extract_all(replace(lower({x}), ' ', ''), {d.lit('(?s).')}" + (", 0)" if d.name == "spark" else ")")
    distinct = f"size(array_distinct({every}))" if d.name == "spark" else f"len(list_distinct({every}))"
    tags, marks = d.count(x, "<[^>]+>"), d.count(x, "[.!?]")
    return [
        {"n_chars": f"cast(length({x}) as bigint)", "n_words": d.words(x), "n_tags": tags, "n_marks": marks, "n_distinct": f"cast({distinct} as bigint)"},
        {
            "too_short": "n_words > 0 AND n_words < 3",
            "html_remnants": "n_words > 0 AND n_tags > n_words * 0.1D",
            "low_diversity": "n_words > 0 AND n_distinct < 5",
            "no_sentences": "n_words > 50 AND n_marks = 0",
        },
        {
            "issues": d.joined(["CASE WHEN n_words = 0 THEN 'empty_text' END", *(f"CASE WHEN {i} THEN '{i}' END" for i in ("too_short", "html_remnants", "low_diversity", "no_sentences"))], ","),
            "quality": "CASE WHEN n_words = 0 THEN 0.0D ELSE 1.0D * CASE WHEN n_words < 10 THEN 0.5D ELSE 1.0D END * CASE WHEN html_remnants THEN 0.3D ELSE 1.0D END * CASE WHEN low_diversity THEN 0.2D ELSE 1.0D END END",
        },
        {"is_valid": "quality > 0.5D AND issues = ''"},
    ]


# ---- speaker lines ----------------------------------------------------------------------------------


def speaker_match(d: Spark) -> Layer:
    """who, rest, party, pattern_index of the first pattern that matches with a valid name; nulls if none does."""
    n = len(R.SPEAKER_PATTERNS)
    start = [r"\A" + p[1:] for p in R.SPEAKER_PATTERNS]
    whole = {f"m{i}": d.ext("text", p, 0) for i, p in enumerate(start)} | {f"who{i}": strip(d, d.ext("text", p, 1)) for i, p in enumerate(start)}
    rest = {f"rest{i}": strip(d, d.tail("text", f"length(m{i})")) for i in range(n)}
    punctuation = r"[.,;:!?()\[\]{}" + '"' + "-]"

    def valid(i: int) -> str:
        who = f"who{i}"
        return (
            f"(m{i} <> '' AND length({who}) BETWEEN 2 AND 100 AND length(rest{i}) >= 5 AND {d.rlike(who, '[A-Za-züäöüúéèàâêîôûç]')}"
            f" AND {d.count(who, punctuation)} * 2 <= length({who}) AND NOT {_any(d, f'lower({who})', R.NOT_A_SPEAKER)})"
        )

    ok = {f"ok{i}": valid(i) for i in range(n)}
    pick = {
        "pattern_index": case([(f"ok{i}", str(i)) for i in range(n)]),
        "who": case([(f"ok{i}", f"who{i}") for i in range(n)]),
        "rest": case([(f"ok{i}", f"rest{i}") for i in range(n)]),
        "party": case([(f"ok{i}", f"nullif({strip(d, d.ext('text', start[i], 2))}, '')" if i in R.WITH_PARTY else "cast(null as varchar(100))" if d.name == "duck" else "cast(null as string)") for i in range(n)]),
    }
    return [whole, rest, ok, pick]


def procedural_line(d: Spark) -> Layer:
    begins = "(" + " OR ".join(d.rlike("text", "(?im)" + p) for p in R.PROCEDURAL_PATTERNS) + ")"
    keys = " + ".join(f"CASE WHEN {d.has('lower(text)', k)} THEN 1 ELSE 0 END" for k in R.PROCEDURAL_KEYWORDS)
    short_chair = f"({d.has('lower(coalesce(who, {}))'.format(chr(39) * 2), 'president')} AND {d.words('text')} < 50)"
    aside = f"(text LIKE '(%' AND text LIKE '%)')"
    return [{"procedural": f"({begins} OR {short_chair} OR ({keys}) >= 2 OR {aside} OR ({d.words('text')} < 10 AND NOT {d.rlike('text', '[.!?]')}))"}]


def time_hint(d: Spark) -> Layer:
    tries = [case([(d.rlike(d.ext("text", "(?i)" + p, g), r"\A\d{1,2}[:.hH]\d{2}"), d.ext("text", "(?i)" + p, g))]) for p, g in R.TIME_PATTERNS]
    return [{"hint": f"replace(replace(coalesce({', '.join(tries)}), 'h', ':'), '.', ':')"}]


def parse_confidence(d: Spark) -> Layer:
    words = d.words("coalesce(rest, '')")
    return [
        {"rest_words": words},
        {
            "confidence": "CASE WHEN who IS NULL THEN NULL ELSE least(1.0D, "
            + total([("length(who) > 10", 0.1), ("party IS NOT NULL", 0.1), ("rest_words > 20", 0.15), ("pattern_index < 3", 0.1)], "0.5D")
            + " + CASE WHEN procedural AND rest_words < 20 THEN 0.1D WHEN NOT procedural AND rest_words > 30 THEN 0.15D ELSE 0.0D END) END"
        },
    ]


def parsed(d: Spark) -> Layer:
    """Head or continuation, with everything that the assembly of segments needs."""
    return [*speaker_match(d), *procedural_line(d), *time_hint(d), *parse_confidence(d), {"new_speaker": d.rlike("text", r"\A\s*[A-ZÜÄÖÚÉ][A-Za-z\s]+[:\-–]")}]


def segment_score(d: Spark, speaker: str = "speaker", text: str = "text", confidence: str = "confidence") -> Layer:
    words = d.words(text)
    return [
        {
            "segment_score": total(
                [(f"length({speaker}) >= 2", 0.3), (f"length({speaker}) > 5", 0.1), (f"length({text}) >= 10", 0.4), (f"length({text}) >= 10 AND {words} > 20", 0.1), (f"length({text}) >= 10 AND {words} > 50", 0.1), (f"{confidence} >= 0.8D", 0.1)]
            )
        },
        {"accepted": f"segment_score >= 0.3D AND length({text}) >= 10"},
    ]


# ---- classifier -------------------------------------------------------------------------------------


def features(d: Spark) -> Layer:
    low, who = "low", "lower(speaker)"
    policy = " + ".join(f"CASE WHEN {d.has(low, w)} THEN 1 ELSE 0 END" for w in R.POLICY)
    return [
        {"low": "lower(text)"},
        {"n_words": d.words("low"), "n_questions": d.count("low", r"\?")},
        {
            "short_text": "n_words < 20",
            "long_text": "n_words > 200",
            "president_speaker": d.has(who, "president"),
            "official_speaker": f"(NOT {d.has(who, 'president')} AND {_any(d, who, R.OFFICIALS)})",
            "parenthetical": "(low LIKE '(%' AND low LIKE '%)')",
            "has_interruptions": _any(d, low, R.INTERRUPTIONS),
            "has_timestamp": d.rlike(low, r"\b\d{1,2}[:.]\d{2}\b"),
            "formal_address": _any(d, low, R.FORMAL),
            "policy_heavy": f"(({policy}) >= 3)",
        },
        {
            "features": d.joined(
                [
                    "CASE WHEN short_text THEN 'short_text' WHEN long_text THEN 'long_text' ELSE 'medium_text' END",
                    "CASE WHEN president_speaker THEN 'president_speaker' WHEN official_speaker THEN 'official_speaker' ELSE 'member_speaker' END",
                    "CASE WHEN parenthetical THEN 'parenthetical' END",
                    "CASE WHEN has_interruptions THEN 'has_interruptions' END",
                    "CASE WHEN n_questions > 2 THEN 'many_questions' WHEN n_questions > 0 THEN 'has_questions' END",
                    *(f"CASE WHEN {f} THEN '{f}' END" for f in ("has_timestamp", "formal_address", "policy_heavy")),
                ],
                ",",
            )
        },
    ]


def classified(d: Spark) -> Layer:
    """features, then content_type, announcement_type, class_confidence, reasoning. Each pattern is tried once."""
    hits = {f"h_{g}_{i}": d.rlike("low", p) for g, ps in R.CLASSIFIER.items() for i, (p, _) in enumerate(ps)}
    groups = {}
    for g, ps in R.CLASSIFIER.items():
        groups[f"n_{g}"] = "(" + " + ".join(f"CASE WHEN h_{g}_{i} THEN 1 ELSE 0 END" for i in range(len(ps))) + ")"
        groups[f"w_{g}"] = total([(f"h_{g}_{i}", w) for i, (_, w) in enumerate(ps)])
    scores = {}
    for c in R.CLASS_ORDER:
        terms = [(f"h_{g}_{i}", w) for g, ps in R.CLASSIFIER.items() if R.GROUP_CLASS[g] == c for i, (_, w) in enumerate(ps)]
        scores[f"s_{c}"] = total(terms + R.FEATURE_WEIGHTS[c])
    best = {"best": "greatest(" + ", ".join(f"s_{c}" for c in R.CLASS_ORDER) + ")"}
    default = [("parenthetical OR has_interruptions", "interruption", 0.6), ("president_speaker AND short_text", "announcement", 0.5), ("long_text OR policy_heavy", "speech", 0.7)]
    kind = case([*((f"best = 0.0D AND ({c})", f"'{k}'") for c, k, _ in default), ("best = 0.0D", "'speech'"), *((f"s_{c} = best", f"'{c}'") for c in R.CLASS_ORDER)])
    sure = case([*((f"best = 0.0D AND ({c})", f"{v!r}D") for c, _, v in default), ("best = 0.0D", "0.3D")], "least(1.0D, best / 2.0D)")
    announced = case([("content_type <> 'announcement'", "NULL"), *((f"n_{g} > 0", f"'{k}'") for g, k in R.ANNOUNCEMENT_BY_GROUP)], "'general_announcement'")
    parts = [f"CASE WHEN n_{g} > 0 THEN concat('{g} patterns (avg weight: ', {d.two(f'w_{g} / n_{g}')}, ')') END" for g in R.CLASSIFIER]
    parts += ["CASE WHEN president_speaker THEN 'president speaker' END", "CASE WHEN short_text THEN 'short text' WHEN long_text THEN 'long text' END"]
    parts += ["CASE WHEN policy_heavy THEN 'policy-heavy content' END", "CASE WHEN parenthetical THEN 'parenthetical format' END"]
    return [
        *features(d), hits, groups, scores, best, {"content_type": kind, "class_confidence": sure}, {"announcement_type": announced},
        {"reasoning": f"coalesce(nullif({d.joined(parts, '; ')}, ''), 'no clear indicators')"},
    ]


def in_context(d: Spark) -> Layer:
    """Confidence after the phase of the session and the previous segment; one window per session."""
    w = "(PARTITION BY session_id ORDER BY seq)"
    return [
        {"place": f"row_number() OVER {w} - 1", "places": "count(*) OVER (PARTITION BY session_id)", "before": f"lag(content_type) OVER {w}"},
        {"phase": case([("place = 0", "'opening'"), ("(place - 1) < places * 0.2D", "'opening'"), ("(place - 1) > places * 0.8D", "'closing'")], "'main'")},
        {"once": "CASE WHEN content_type = 'speech' AND phase <> 'main' AND class_confidence < 0.8D THEN class_confidence * 0.9D ELSE class_confidence END"},
        {"context_confidence": "CASE WHEN content_type = 'speech' AND before = 'announcement' AND once < 0.6D THEN once * 0.8D ELSE once END"},
    ]


# ---- validation -------------------------------------------------------------------------------------

# fixed values: severities, penalties and bonuses
PENALTY = {"critical": 0.4, "high": 0.2, "medium": 0.1, "low": 0.05}
SEVERITY = {"empty_text": "critical", "too_short": "high", "html_remnants": "medium", "low_diversity": "medium", "no_sentences": "low"}
VALID_NAME = r"\A[A-ZÜÄÖÚÉ][A-Za-züäöüúéèàâêîôûç'\-\s.]+$"
SUSPICIOUS = r"[<>{}\[\]|\\@#$%^&*+=_~`]"


def segment_issues(d: Spark) -> Layer:
    """issue_list 'category:severity:what', per-severity counts and the segment's validation score.

    Needs text_quality, time_hint (hint), procedural, content_type, class_confidence and confidence.
    """
    hour, minute = (f"cast(nullif(regexp_extract(hint, {d.lit('([0-9]+)[:.]([0-9]+)')}, {g}), '') as int)" for g in (1, 2))
    found = [
        ("speaker_quality", "critical", "empty", "speaker = ''"),
        ("speaker_quality", "high", "short", "length(speaker) = 1"),
        ("speaker_quality", "high", "long", "length(speaker) > 100"),
        ("speaker_quality", "medium", "characters", f"speaker <> '' AND {d.rlike('speaker', SUSPICIOUS)}"),
        ("speaker_quality", "medium", "format", f"speaker <> '' AND NOT {d.rlike('speaker', VALID_NAME)}"),
        ("content_quality", "critical", "empty", "text = ''"),
        *(("content_quality", s, k, f"text <> '' AND NOT is_valid AND {('n_words = 0' if k == 'empty_text' else k)}") for k, s in SEVERITY.items()),
        ("content_quality", "high", "short", "text <> '' AND length(text) < 10"),
        ("content_quality", "medium", "long", "length(text) > 10000"),
        ("timestamp_validity", "high", "hour", f"coalesce({hour} > 23, false)"),
        ("timestamp_validity", "high", "minute", f"coalesce({minute} > 59, false)"),
        ("classification_accuracy", "medium", "disagrees", "procedural AND content_type NOT IN ('procedural', 'announcement') AND class_confidence > 0.7D"),
        ("classification_accuracy", "high", "confidence", "score_in < 0.3D"),
    ]
    counts = {f"n_{s}": "(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for _, sev, _, c in found if sev == s) + ")" if any(x[1] == s for x in found) else "0" for s in PENALTY}
    bonus = total([(f"length(speaker) > 5 AND {d.rlike('speaker', VALID_NAME)}", 0.1), ("n_words BETWEEN 20 AND 500", 0.1), ("hint IS NOT NULL", 0.05), ("true", 0.05)])
    return [
        {"score_in": "coalesce(nullif(confidence, 0.0D), 0.5D)"},
        {"issue_list": d.joined([f"CASE WHEN {c} THEN '{cat}:{sev}:{what}' END" for cat, sev, what, c in found], ","), **counts, "bonus": bonus},
        {"penalty": "n_critical * 0.4D + n_high * 0.2D + n_medium * 0.1D + n_low * 0.05D"},
        {"validation_score": "greatest(0.0D, least(1.0D, score_in + bonus - penalty))"},
    ]
