"""Quality rules, line first: drop the lines that fail a rule, then drop documents that lose too much.

DataFrame functions only; one pass over the text, no shuffle, no Python on the executors.

Defined cases
    null text: no words, no lines; fails the base rule (under 20 words), so it is not kept.
    empty text or white space only: the same.
    lines without a word: kept in the cleaned text, counted in no figure.
    very long texts: every array function used is linear or n log n in the words of one text.
    ties and repeated rows: each row is judged by itself.
    empty table: empty result with the same columns. Extra columns: ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import fresh, let, table, words_of

SYMBOLS = "[#*$%&|<>]"
#: Marks that ordinary prose rarely has in one word out of ten characters.
NOISE = "[#*$%&|<>!~^=_]"
NAVIGATION = r"(?i)^[\x20\x09-\x0D]*(home|menu|search|login|log in|sign in|sign up|register|next|previous|back to top|read more|share|sitemap|contact us|about us|skip to content)[\x20\x09-\x0D]*$"
BOILERPLATE = r"(?i)(all rights reserved|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|accept cookies|enable javascript|click here|lorem ipsum|copyright \(c\)|subscribe to our newsletter)"
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Boilerplate phrases condemn a line of which they are so many percent; in a longer paragraph they are a mention.
PHRASE_PERCENT = 10
#: A menu: words between separators, and no mark of punctuation that ends a sentence.
SEPARATOR = r"[\x20\x09](?:[|•·»›>]|::|->)[\x20\x09]"
LEAST_SEPARATORS = 2
ENDS = r"[.!?:;,)\]\"'”’…。！？][\x20\x09-\x0D]*$"
NOISE_PERCENT, MAX_BARS, KEPT_PERCENT, WINDOW, LEAST_WORDS, REPEAT_PERCENT = 10, 3, 60, 8, 20, 30


def line_fails(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules on one line."""
    noise = F.regexp_count(line, F.lit(NOISE)) * 100 > F.length(line) * NOISE_PERCENT
    bars = F.regexp_count(line, F.lit(r"\|")) >= MAX_BARS
    menu = (F.regexp_count(line, F.lit(SEPARATOR)) >= LEAST_SEPARATORS) & ~line.rlike(ENDS)
    phrases = F.length(line) - F.length(F.regexp_replace(line, BOILERPLATE, ""))
    boilerplate = F.when(line.rlike(BOILERPLATE), phrases * 100 >= F.length(line) * PHRASE_PERCENT).otherwise(F.lit(False))
    return noise | bars | menu | line.rlike(NAVIGATION) | boilerplate


def _total_length(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x))


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more; hashes[i] is that of the window at i."""

    def among(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return let(
            F.sort_array(F.transform(twice, lambda x: x["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda acc, x: acc + x,
            ),
        )

    return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), among)


def _word_figures(words: Column) -> Column:
    def windows(hashed: Column) -> Column:
        return F.when(
            F.size(hashed) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(hashed) - WINDOW),
                lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    def repeats(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _covered(hashes)).otherwise(F.lit(0).cast("long"))

    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        _total_length(words).alias("word_chars"),
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda wh: let(windows(wh), repeats)).alias("n_repeat_words"),
    )


def _line_figures(lines: Column) -> Column:
    def judged(full: Column) -> Column:
        return F.struct(
            (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
            _total_length(full).alias("line_chars"),
            _total_length(F.filter(full, lambda x: ~line_fails(x))).alias("kept_chars"),
        )

    return let(F.filter(lines, lambda x: x.rlike(HAS_WORD)), judged)


def figures(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row, with the base counts and the verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select(
        "doc_id",
        "text",
        let(words_of(F.col("text")), _word_figures).alias("w"),
        let(F.split(text, "\n"), _line_figures).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    base = (F.col("w.n_words") < LEAST_WORDS) | (F.col("w.n_repeat_words") * 100 > F.col("w.n_words") * REPEAT_PERCENT)
    enough = F.col("l.kept_chars") * 100 >= F.col("l.line_chars") * KEPT_PERCENT
    return seen.select(
        "doc_id",
        "text",
        "w.n_words",
        "w.word_chars",
        "n_symbols",
        "l.n_dup_lines",
        "w.n_repeat_words",
        base.alias("base_failed"),
        (~base & enough).alias("kept"),
        (F.col("l.line_chars") - F.col("l.kept_chars")).alias("removed_chars"),
    )


def cleaned(text: Column) -> Column:
    """The text without its failing lines."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(HAS_WORD) | ~line_fails(x)), "\n")


def apply_rules(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns; text is cleaned and n_chars follows it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    flag = fresh(docs, "rules_kept")
    seen = docs.withColumn(
        flag,
        F.struct(let(words_of(F.col("text")), _word_figures).alias("w"), let(F.split(text, "\n"), _line_figures).alias("l")),
    )
    n, again = F.col(f"{flag}.w.n_words"), F.col(f"{flag}.w.n_repeat_words")
    good = (
        (n >= LEAST_WORDS)
        & (again * 100 <= n * REPEAT_PERCENT)
        & (F.col(f"{flag}.l.kept_chars") * 100 >= F.col(f"{flag}.l.line_chars") * KEPT_PERCENT)
    )
    out = seen.where(good).drop(flag).withColumn("text", cleaned(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures(table(spark, sf_dir, "documents")).drop("text")


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i+7], ' ') AS s FROM d, unnest(range(1, len(w) - 6)) AS u(i) WHERE len(w) >= 8),
twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS n FROM win) WHERE n > 1),
cover AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) AS v(k) GROUP BY rid),
line AS (SELECT rid, l FROM d, unnest(string_split(text, chr(10))) AS x(l) WHERE regexp_matches(l, '{HAS_WORD}')),
judged AS (SELECT rid, l, length(l) AS n,
    len(regexp_extract_all(l, '{NOISE}')) * 100 > length(l) * {NOISE_PERCENT}
    OR len(regexp_extract_all(l, '\|')) >= {MAX_BARS}
    OR len(regexp_extract_all(l, '{SEPARATOR}')) >= {LEAST_SEPARATORS} AND NOT regexp_matches(l, '{ENDS.replace("'", "''")}')
    OR regexp_matches(l, '{NAVIGATION}')
    OR regexp_matches(l, '{BOILERPLATE}') AND (length(l) - length(regexp_replace(l, '{BOILERPLATE}', '', 'g'))) * 100 >= length(l) * {PHRASE_PERCENT} AS bad FROM line),
lines AS (SELECT rid, count(*) - count(DISTINCT l) AS dup, sum(n) AS total, coalesce(sum(n) FILTER (NOT bad), 0) AS good FROM judged GROUP BY rid),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
    coalesce(cover.n, 0)::BIGINT AS n_repeat_words, coalesce(total, 0)::BIGINT AS total, coalesce(good, 0)::BIGINT AS good
  FROM d LEFT JOIN cover USING (rid) LEFT JOIN lines USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND good * 100 >= total * {KEPT_PERCENT} AS kept, total - good AS removed_chars FROM b
"""
