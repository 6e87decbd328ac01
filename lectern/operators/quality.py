"""Text quality along four dimensions, overall score and level, as layers over a column text (and lang).

One wide projection per document; only the share of the most frequent word needs a nested aggregation, which stays
inside the row. Language is scored by stop words, sentences end at . ! or ?, syllables are vowel groups: these three
are our own definitions, where the original relies on undeclared libraries.
"""

from __future__ import annotations

from lectern.functions.dialect import Spark, case, total

# fixed values: indicator words and shapes
SPEAKERS = r"(?i)(?:president|commissioner|mr|mrs|ms)\s*[.:]"
HEADINGS = r"(?m)^[A-Z\s]{10,}$"
SUBSTANTIVE = r"(?i)\b(?:europe|parliament|commission|council|member|states?|union|policy|law|regulation|directive)\b"
PROCEDURAL = r"(?i)\b(?:amendment|vote|debate|committee|report|opinion|resolution)\b"
MARKERS = r"(?i)\b(?:however|therefore|furthermore|moreover|nevertheless|consequently)\b"
RELEVANT = ["european", "parliament", "commission", "council"]
WEIGHTS = {"structural": 0.25, "content": 0.30, "linguistic": 0.20, "metadata": 0.15}
LEVELS = [(0.9, "excellent"), (0.75, "good"), (0.6, "acceptable"), (0.4, "poor")]
# our own stop words for the languages of the test tables
STOP_WORDS = {"en": "the|and|of|to|in|is|that|it|was|for", "fr": "le|la|les|de|et|un|une|que|pour|dans", "de": "der|die|und|das|von|zu|mit|ist|im|ein", "es": "el|los|las|que|y|en|del|por|con|su"}

Layer = list[dict[str, str]]


def _paragraphs(d: Spark) -> str:
    if d.name == "spark":
        return r"filter(transform(split(text, r'\n\n'), x -> regexp_replace(x, r'^\s+|\s+$', '')), x -> x <> '')"
    return r"list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"


def _filtered(d: Spark, array: str, test: str) -> str:
    return f"size(filter({array}, x -> {test}))" if d.name == "spark" else f"len(list_filter({array}, lambda x: {test}))"


def structural(d: Spark) -> Layer:
    lines = r"transform(split(text, r'\n'), x -> regexp_replace(x, r'^\s+|\s+$', ''))" if d.name == "spark" else r"list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))"
    words = r"filter(split(text, r'\s+'), x -> x <> '')" if d.name == "spark" else r"regexp_extract_all(text, '\S+')"
    head = "slice(words, 1, 100)" if d.name == "spark" else "words[1:100]"
    upper = "substring(x, 1, 1) <> lower(substring(x, 1, 1))"
    mean = "aggregate(transform(paragraphs, x -> cast(length(x) as double)), 0.0D, (a, x) -> a + x, a -> a / size(paragraphs))" if d.name == "spark" else "list_avg(list_transform(paragraphs, lambda x: length(x)::DOUBLE))"
    spread = "sqrt(aggregate(transform(paragraphs, x -> pow(length(x) - mean_p, 2)), 0.0D, (a, x) -> a + x) / (size(paragraphs) - 1))" if d.name == "spark" else "list_stddev_samp(list_transform(paragraphs, lambda x: length(x)::DOUBLE))"
    n = "size(paragraphs)" if d.name == "spark" else "len(paragraphs)"
    size = "size(words)" if d.name == "spark" else "len(words)"
    split_len = r"size(split(text, r'\n\n'))" if d.name == "spark" else "len(string_split(text, chr(10) || chr(10)))"
    return [
        {"paragraphs": _paragraphs(d), "lines_": lines, "words": words, "sentences": f"({d.count('text', '[.!?]+')} + 1)"},
        {"n_words": f"cast({size} as bigint)", "long_lines": _filtered(d, "lines_", "length(x) >= 10"), "speaker_lines": _filtered(d, "lines_", f"length(x) >= 10 AND {d.rlike('x', chr(92) + 'A[A-Za-zÀ-ÿ' + chr(92) + 's]+[.–—:]')}"), "mean_p": f"CASE WHEN {n} > 0 THEN {mean} END"},
        {"spread_p": f"CASE WHEN {n} > 1 THEN {spread} END", "capitals": _filtered(d, head, upper)},
        {
            "document_structure": f"least(1.0D, {total([(f'length(text) > 100', 0.2), (d.rlike('text', HEADINGS), 0.3), (f'{split_len} >= 3', 0.2), (d.rlike('text', SPEAKERS), 0.3)])})",
            "speaker_structure": "CASE WHEN long_lines = 0 THEN 0.0D ELSE least(1.0D, speaker_lines * 1.0D / long_lines) END",
            "formatting": f"least(1.0D, {total([('sentences > 5', 0.2), (d.count('text', chr(92) + 's{3,}') + ' < length(text) / 1000.0D', 0.2), ('n_words > 10 AND capitals * 1.0D / least(100, n_words) > 0.1D', 0.1)], '0.5D')})",
            "segmentation": f"CASE WHEN {n} = 0 THEN 0.0D WHEN {n} > 1 AND spread_p / mean_p BETWEEN 0.3D AND 1.5D THEN 0.8D ELSE 0.5D END",
        },
        {"structural": "(document_structure + speaker_structure + formatting + segmentation) / 4.0D"},
    ]


def content(d: Spark) -> Layer:
    relevant = " + ".join(f"CASE WHEN {d.has('lower(text)', w)} THEN 1 ELSE 0 END" for w in RELEVANT)
    return [
        {"n_procedural": d.count("text", PROCEDURAL), "n_markers": d.count("text", MARKERS), "n_substantive": d.count("text", SUBSTANTIVE), "n_complex": d.count("text", "[,;:]"), "sentence_words": "n_words * 1.0D / sentences"},
        {
            "completeness": "least(1.0D, CASE WHEN length(text) > 500 THEN 0.3D WHEN length(text) > 100 THEN 0.1D ELSE 0.0D END + CASE WHEN n_procedural >= 3 THEN 0.3D WHEN n_procedural >= 1 THEN 0.1D ELSE 0.0D END)",
            "coherence": "CASE WHEN sentences < 3 THEN 0.3D ELSE least(1.0D, 0.5D + CASE WHEN n_markers > 0 THEN least(0.3D, n_markers * 0.1D) ELSE 0.0D END + CASE WHEN sentences > 3 AND sentence_words BETWEEN 8.0D AND 25.0D THEN 0.2D ELSE 0.0D END) END",
            "depth": "CASE WHEN n_words < 50 THEN 0.2D ELSE least(1.0D, 0.3D + CASE WHEN n_substantive > n_words * 0.05D THEN 0.4D WHEN n_substantive > n_words * 0.02D THEN 0.2D ELSE 0.0D END + CASE WHEN n_complex > n_words / 20.0D THEN 0.3D ELSE 0.0D END) END",
            "relevance": f"least(1.0D, ({relevant}) / {len(RELEVANT)}.0D)",
        },
        {"content": "(completeness + coherence + depth + relevance) / 4.0D"},
    ]


def linguistic(d: Spark) -> Layer:
    plain = "regexp_extract_all(lower(text), r'[a-zà-ÿ]+', 0)" if d.name == "spark" else "regexp_extract_all(lower(text), '[a-zà-ÿ]+')"
    size = (lambda a: f"size({a})") if d.name == "spark" else (lambda a: f"len({a})")
    distinct = "size(array_distinct(plain))" if d.name == "spark" else "len(list_distinct(plain))"
    if d.name == "spark":
        # A blank before the text stands for its beginning, so that a pattern begins with one class; letters go by runs.
        votes = {f"v_{k}": d.count("concat(' ', lower(text))", rf"\s(?:{w})[\s.,]") for k, w in STOP_WORDS.items()}
        letters = r"cast(length(text) - length(regexp_replace(text, r'[^\s.,;:!?]+', '')) as bigint)"
    else:
        votes = {f"v_{k}": d.count("lower(text)", rf"(?:^|\s)(?:{w})[\s.,]") for k, w in STOP_WORDS.items()}
        letters = d.count("text", r"[^\s.,;:!?]")
    best = "greatest(" + ", ".join(votes) + ")"
    starts = r"[.!?]+\s+[A-Z]", r"[.!?]+\s+[A-Za-z]"
    return [
        {"plain": plain, **votes, "syllables": d.count("lower(text)", "[aeiouyàâäéèêëîïíóôöúùûü]+"), "letters": letters},
        {"n_plain": f"cast({size('plain')} as bigint)", "n_distinct": f"cast({distinct} as bigint)", "n_long": f"cast({_filtered(d, 'plain', 'length(x) >= 6')} as bigint)", "votes": "(" + " + ".join(votes) + ")"},
        {
            "detected": case([("votes = 0", "'und'"), *((f"v_{k} = {best}", f"'{k}'") for k in STOP_WORDS)]),
            "language_share": f"CASE WHEN votes = 0 THEN 0.0D ELSE {best} * 1.0D / votes END",
            "flesch": "206.835D - 1.015D * n_words / sentences - 84.6D * syllables / greatest(n_words, 1)",
            "ari": "4.71D * letters / greatest(n_words, 1) + 0.5D * n_words / sentences - 21.43D",
            "diversity": "n_distinct * 1.0D / greatest(n_plain, 1)",
        },
        {
            "consistency": "CASE WHEN votes = 0 THEN 0.3D WHEN detected = lang THEN least(1.0D, language_share + 0.2D) ELSE greatest(0.1D, language_share - 0.3D) END",
            "readability": "(flesch / 100.0D + greatest(0.0D, least(1.0D, (15.0D - ari) / 10.0D))) / 2.0D",
            "grammar": f"least(1.0D, 0.7D + CASE WHEN sentences > 2 THEN 0.1D ELSE 0.0D END + CASE WHEN {d.count('text', starts[0])} > {d.count('text', starts[1])} * 0.8D THEN 0.1D ELSE 0.0D END)",
            "vocabulary": "CASE WHEN n_plain < 10 THEN 0.3D ELSE (CASE WHEN diversity BETWEEN 0.4D AND 0.7D THEN 1.0D WHEN diversity > 0.7D THEN 0.8D ELSE diversity / 0.4D END + least(1.0D, n_long * 4.0D / n_plain)) / 2.0D END",
        },
        {"linguistic": "(consistency + readability + grammar + vocabulary) / 4.0D"},
    ]


def overall(d: Spark) -> Layer:
    base = " + ".join(f"{k} * {w!r}D" for k, w in WEIGHTS.items())
    return [
        {"metadata": "(CASE WHEN lang IS NOT NULL THEN 0.8D ELSE 0.2D END + CASE WHEN source IS NOT NULL THEN 1.0D ELSE 0.5D END) / 2.0D"},
        {"critical": "length(text) < 50", "medium": "CASE WHEN source IS NULL THEN 1 ELSE 0 END"},
        {"score": f"greatest(0.0D, ({base}) / 0.9D - CASE WHEN critical THEN 0.3D ELSE 0.0D END - medium * 0.05D)"},
        {"level": case([("critical", "'unacceptable'"), *((f"score >= {v!r}D", f"'{k}'") for v, k in LEVELS)], "'unacceptable'")},
        {
            "rules": d.joined(["CASE WHEN critical THEN 'CONTENT_MIN_LENGTH' END", "CASE WHEN speaker_lines = 0 THEN 'SPEAKER_PRESENT' END", "CASE WHEN lang IS NULL OR source IS NULL THEN 'METADATA_COMPLETENESS' END"], ","),
            "production_ready": "score >= 0.75D AND NOT critical",
            "needs_review": "score < 0.6D OR critical",
            "potential": "greatest(0.0D, 1.0D - score)",
        },
    ]


def assessed(d: Spark) -> Layer:
    return [*structural(d), *content(d), *linguistic(d), *overall(d)]
