"""Time mentions of texts: all of them with their places, what they say, how sure they are, and whose speech they date.

Places come from one Arrow-batched pass of `re` over whole texts, as built-in expressions tell no positions; all that
follows from a mention (time, confidence, event, repeats, association) is in DataFrame functions.

Null texts have no mentions. Mentions of different patterns may overlap; all are told, repeats() settles them.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import rules as R
from lectern.operators.lifecycle import ladder

SCANNED = ["pattern", "start", "stop", "match", "before", "after", "groups"]
SLICE = 64


def _kinds() -> tuple[T.DataType, pa.DataType]:
    spark = T.ArrayType(
        T.StructType().add("pattern", "integer").add("start", "long").add("stop", "long").add("match", "string").add("before", "string").add("after", "string").add("groups", T.ArrayType(T.StringType()))
    )
    arrow = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string())]
    return spark, pa.list_(pa.struct(list(zip(SCANNED, arrow))))


def everywhere(text: str, compiled: list[re.Pattern]) -> Iterator[tuple[int, int, re.Match]]:
    """start, number of the pattern, match: all matches of any patterns."""
    return ((m.start(), k, m) for k, p in enumerate(compiled) for m in p.finditer(text))


_DIGITS = re.compile(r"\d+")


def _word_before(text: str, at: int) -> int:
    """Where the white space before `at` begins."""
    reach = 64
    while True:
        low = max(0, at - reach)
        rest = len(text[low:at].rstrip())
        if rest or not low:
            return low + rest
        reach *= 2


def at_digits(text: str, compiled: list[re.Pattern]) -> Iterator[tuple[int, int, re.Match]]:
    """The same for MENTION_PATTERNS, which hold digits in known places: patterns are tried only there, in order of start, each
    from the end of its last match on. A clock begins at a run of one or two digits before its mark, which by \\b no
    letter or digit precedes; a word pattern ends in white space and digits, so its words stand before a run."""
    free = [0] * len(compiled)
    for run in _DIGITS.finditer(text):
        start, stop = run.span()
        tries = []
        if start and text[start - 1].isspace():
            end = _word_before(text, start)
            # Only last and first letters are looked at: `re` knows other forms of some, as ſ of s, but not of these.
            last = text[end - 1 : end].lower()
            tries += [(end - len(w), k) for k, words in R.MENTION_WORDS.items() for w in words if w[-1] == last and end >= len(w)]
            if last == "t" and text[max(0, end - 4) : end][:1] in ("p", "P"):
                head = _word_before(text, end - 4)
                tries += [(head - n, R.MENTION_PAST) for n in R.MENTION_PARTS if head >= n]
        if stop < len(text):
            after = text[stop]
            if stop - start <= 2:
                tries += [(start, k) for k in R.MENTION_MARKS.get(after.lower(), ())]
            if after.isspace():
                tries.append((start, R.MENTION_PAST))
        for at, k in tries:
            if at >= free[k] and (m := compiled[k].match(text, at)):
                free[k] = m.end()
                yield at, k, m


def scan(text: Column, patterns: list[str], around: int, found: Callable = everywhere) -> Column:
    """All matches of all patterns: pattern (its number), start and stop in code points, match, up to `around` characters
    before and after it, groups. In order of start, then of patterns. Null for a null text.

    A batch is read text by text and told in slices of SLICE, so what a worker holds besides the batch does not grow with it."""
    spark_kind, arrow_kind = _kinds()

    @F.arrow_udf(spark_kind)
    def scanned(texts: pa.Array) -> pa.Array:
        compiled = [re.compile(p, re.IGNORECASE) for p in patterns]

        def told(t: str | None) -> list[dict] | None:
            if t is None:
                return None
            all_ = sorted(found(t, compiled), key=lambda x: x[:2])
            return [dict(zip(SCANNED, (k, a, m.end(), m[0], t[max(0, a - around) : a], t[m.end() : m.end() + around], list(m.groups())))) for a, k, m in all_]

        slices = [pa.array((told(t.as_py()) for t in texts.slice(i, SLICE)), arrow_kind) for i in range(0, len(texts), SLICE)]
        return pa.concat_arrays(slices) if slices else pa.array([], arrow_kind)

    return scanned(text)


def _time(group: Column, kind: Column) -> Column:
    """The time that the groups of a mention say, in seconds; null if there is none."""
    number = lambda k: F.coalesce(F.try_element_at(group, F.lit(k)).cast("int"), F.lit(0))
    marked = lambda *kinds: kind.isin(*kinds)
    half = F.upper(F.when(marked("hh_mm_ss_ampm"), F.try_element_at(group, F.lit(4))).when(marked("hh_mm_ampm"), F.try_element_at(group, F.lit(3))))
    hour = F.when(half.isin("PM", "P.M.") & (number(1) < 12), number(1) + 12).when(half.isin("AM", "A.M.") & (number(1) == 12), 0).otherwise(number(1))
    second = F.when(marked("hh_mm_ss", "hh_mm_ss_ampm"), number(3)).otherwise(0)
    return F.when((hour <= 23) & (number(2) <= 59) & (second <= 59), hour * 3600 + number(2) * 60 + second)


def _near(words: list[str], text: Column) -> Column:
    return functools.reduce(operator.or_, (F.contains(text, F.lit(w)) for w in words), F.lit(False))


def mentions(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, pattern, format, start, stop, match, seconds (of the day), sure, confidence, event, context_before, context_after."""
    # A text without a digit has no mention, so Python does not see it.
    some = texts.where(F.col(text).rlike(r"\d")).select(key, scan(F.col(text), [p for _, _, p in R.MENTION_PATTERNS], R.MENTION_CONTEXT, at_digits).alias("__m"))
    wide = some.select(key, F.inline("__m"))
    kinds = F.array(*(F.lit(f) for f, _, _ in R.MENTION_PATTERNS))
    worth = F.array(*(F.lit(w) for _, w, _ in R.MENTION_PATTERNS))
    at = F.col("pattern") + 1
    told = wide.withColumn("format", F.element_at(kinds, at)).withColumn("seconds", _time(F.col("groups"), F.col("format"))).where("seconds IS NOT NULL")
    context = F.lower(F.concat("before", F.lit(" "), "after"))
    whole = F.lower(F.concat("before", F.lit(" "), "match", F.lit(" "), "after"))
    any_of = lambda patterns: functools.reduce(operator.or_, (context.rlike("(?id)" + p) for p in patterns))
    boost = F.when(any_of(R.PARLIAMENT_TIMES), F.lit(R.PARLIAMENT_BOOST)).otherwise(0.0)
    for patterns in R.TIME_CONTEXTS.values():
        boost = boost + F.when(any_of(patterns), F.lit(R.CONTEXT_BOOST)).otherwise(0.0)
    told = told.withColumn("sure", F.least(F.lit(1.0), F.element_at(worth, at) + boost))
    arms = [(F.col("sure") >= least, F.lit(name)) for name, least, _ in R.TIME_CONFIDENCE[:-1]]
    events = [(_near(words, whole), F.when(_near(also, whole), event).otherwise(other) if also else F.lit(event)) for words, also, event, other in R.TIME_EVENTS]
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    return told.select(
        key, "pattern", "format", "start", "stop", "match", "seconds", "sure",
        ladder(arms, F.lit(R.TIME_CONFIDENCE[-1][0])).alias("confidence"),
        ladder(events, F.lit(R.OTHER_EVENT)).alias("event"),
        bare("before").alias("context_before"), bare("after").alias("context_after"),
    )


def without_repeats(told: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of mentions of one time within one stretch of a text the first, equal starts by the order of patterns."""
    rest = [c for c in told.columns if c not in (key, "seconds")]
    first = ["start", "pattern", *[c for c in rest if c not in ("start", "pattern")]]
    stretch = F.floor(F.col("start") / R.MENTION_BUCKET).alias("__stretch")
    best = told.groupBy(key, "seconds", stretch).agg(F.min(F.struct(*first)).alias("__m"))
    return best.select(key, "seconds", "__m.*").select(*told.columns)


def associated(speeches: DataFrame, told: DataFrame, key: str = "doc_id", start: str = "speech_start", speaker: str = "speaker") -> DataFrame:
    """speeches with the best mention within reach of their start: seconds, mention_start, timing (its confidence as a
    number) and score; null if none is near.

    A band join on stretches as wide as the reach: a speech meets three of them, a mention stays in its own. Equal scores
    go to the earlier mention."""
    distance_share, sure_share, speaker_share, start_share = R.ASSOCIATION
    bucket = lambda c: F.floor(F.col(c) / R.MENTION_REACH)
    near = speeches.withColumn("__b", F.explode(F.array(*(bucket(start) + k for k in (-1, 0, 1)))))
    own = told.select(F.col(key).alias("__key"), bucket("start").alias("__at"), F.col("start").alias("mention_start"), "pattern", "seconds", "confidence", "event", F.lower(F.concat("context_before", F.lit(" "), "context_after")).alias("__context"))
    distance = F.abs(F.col("mention_start") - F.col(start))
    met = near.join(own, (F.col(key) == F.col("__key")) & (F.col("__b") == F.col("__at")) & (distance <= R.MENTION_REACH))
    timing = ladder([(F.col("confidence") == name, F.lit(worth)) for name, _, worth in R.TIME_CONFIDENCE], F.lit(0.0))
    words = F.slice(F.filter(F.split(F.lower(F.coalesce(speaker, F.lit(""))), r"\s+"), lambda w: w != ""), 1, 3)
    said = F.exists(words, lambda w: F.contains(F.col("__context"), w))
    score = (1.0 - distance / R.MENTION_REACH) * distance_share + timing * sure_share
    score = score + F.when(said, F.lit(speaker_share)).otherwise(0.0) + F.when(F.col("event") == R.OTHER_EVENT, F.lit(start_share)).otherwise(0.0)
    rank = F.struct((-score).alias("less"), "mention_start", "pattern", "seconds", timing.alias("timing"))
    best = met.groupBy(key, start).agg(F.min(rank).alias("__m"))
    out = best.select(F.col(key).alias("__key"), F.col(start).alias("__start"), "__m.seconds", "__m.mention_start", "__m.timing", (-F.col("__m.less")).alias("score"))
    return speeches.join(out, (F.col(key) == F.col("__key")) & (F.col(start) == F.col("__start")), "left").drop("__key", "__start")
