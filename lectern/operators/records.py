"""Rules on single records and small groups of them: times, dates, orders, schedules, spreads."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import rules as R


def _some(text: Column, words: list[str]) -> Column:
    return functools.reduce(operator.or_, (F.contains(text, F.lit(w)) for w in words))


def speaking_minutes(text: Column) -> Column:
    """By words, longer for sounds from the floor and for questions, half a minute at least; 0 for no text."""
    low = F.lower(text)
    words = F.regexp_count(text, F.lit(r"\S+")) / F.lit(float(R.WORDS_A_MINUTE))
    longer = words * F.when(_some(low, R.PAUSES), 1.2).otherwise(1.0) * F.when(_some(low, R.QUESTIONS), 1.1).otherwise(1.0)
    return F.when(F.coalesce(text, F.lit("")) == "", 0.0).otherwise(F.greatest(longer, F.lit(R.LEAST_MINUTES)))


def written_date(text: Column) -> Column:
    """The date by the first format that reads it, null if none does."""
    bare = F.trim(text)
    return F.coalesce(*(F.try_to_date(bare, f) for f in R.DATE_FORMATS))


def is_iso(text: Column) -> Column:
    """Whether a text is an ISO 8601 date, with or without a time and an offset; the parts must be possible ones."""
    shape = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?(?:Z|[+-]\d{2}:\d{2})?)?$"
    part = lambda p, most: F.coalesce(F.nullif(F.regexp_extract(text, p, 1), F.lit("")).cast("int") <= most, F.lit(True))
    times = part(r"^.{10}[T ](\d{2})", 23) & part(r"^.{10}[T ]\d{2}:(\d{2})", 59) & part(r"^.{10}[T ]\d{2}:\d{2}:(\d{2})", 59)
    offset = part(r"^.{12,}[+-](\d{2}):\d{2}$", 23) & part(r"^.{12,}[+-]\d{2}:(\d{2})$", 59)
    return F.coalesce(text.rlike(shape) & F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd").isNotNull() & times & offset, F.lit(False))


def date_ranges(spans: DataFrame, start: str, end: str, size: str) -> DataFrame:
    """spans with first and last of each range: size // 2 days long, a week at least, the next begins on the day after;
    none where the start is not before the end."""
    days = F.greatest(F.lit(R.LEAST_DAYS), F.floor(F.col(size) / 2)).cast("int")
    n = F.ceil(F.datediff(F.col(end), F.col(start)) / (days + 1)).cast("int")
    k = F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)))
    wide = spans.withColumn("__days", days).withColumn("__k", k)
    first = F.date_add(F.col(start), F.col("__k") * (F.col("__days") + 1))
    return wide.withColumn("first", first).withColumn("last", F.least(F.date_add("first", F.col("__days")), F.col(end))).drop("__days", "__k")


def out_of_order(rows: DataFrame, key: str, arrived: list[str], number: str) -> DataFrame:
    """key, out_of_order: whether numbers fall anywhere in the order in which rows arrived."""
    falls = F.lag(number).over(W.partitionBy(key).orderBy(*arrived)) > F.col(number)
    return rows.withColumn("__falls", F.coalesce(falls, F.lit(False))).groupBy(key).agg(F.bool_or("__falls").alias("out_of_order"))


def merged(*maps: Column) -> Column:
    """One map of several; of a key in more than one the last counts. Null maps are empty."""

    def two(first: Column, more: Column) -> Column:
        rest = F.map_filter(first, lambda k, v: ~F.array_contains(F.map_keys(more), k))
        return F.when(more.isNull(), first).when(first.isNull(), more).otherwise(F.map_concat(rest, more))

    return functools.reduce(two, maps)


def paragraph_spread(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, mean, spread (of a sample), variation and score: how the lengths of paragraphs, which empty lines part, vary."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")
    sizes = texts.select(key, F.transform(parts, lambda p: F.length(p).cast("double")).alias("__n")).withColumn("n", F.size("__n"))
    mean = F.aggregate("__n", F.lit(0.0), lambda a, x: a + x) / F.col("n")
    told = sizes.withColumn("mean", F.when(F.col("n") > 0, mean))
    square = F.aggregate("__n", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean")))
    spread = F.when(F.col("n") > 1, F.sqrt(square / (F.col("n") - 1))).otherwise(0.0)
    told = told.withColumn("spread", spread).withColumn("variation", F.coalesce(F.try_divide("spread", "mean"), F.lit(0.0)))
    score = F.when(F.col("n") == 0, 0.0).when((F.col("n") > 1) & F.col("variation").between(0.3, 1.5), 0.8).otherwise(0.5)
    return told.withColumn("score", score).drop("__n")


def schedule(sessions: DataFrame, now: Column, available: dict[str, float]) -> DataFrame:
    """Waiting sessions (state queued or prioritized) that may start by their earliest start and by what they need of each
    resource (map `needs`), with overdue where their latest start has passed; in order of schedule, priority, creation, id
    their place is `place` among those of their owner."""
    enough = functools.reduce(operator.and_, (F.coalesce(F.col("needs")[r] <= most, F.lit(True)) for r, most in available.items()), F.lit(True))
    known = F.coalesce(F.size(F.map_filter("needs", lambda k, v: ~k.isin(*available) & (v > 0))) == 0, F.lit(True))
    may = F.col("state").isin("queued", "prioritized") & (F.col("earliest").isNull() | (F.col("earliest") <= now)) & enough & known
    some = sessions.where(may).withColumn("overdue", F.coalesce(now > F.col("latest"), F.lit(False)))
    order = W.partitionBy("owner").orderBy(F.coalesce("scheduled", now), "priority", "created", "id")
    return some.withColumn("place", F.row_number().over(order))


def validation_statistics(log: DataFrame, key: str, spent: str, critical: str, level: str) -> DataFrame:
    """key, assessments, mean (of what they took), critical_rate, and levels: how many had each level, by name."""
    by = log.groupBy(key, level).agg(F.count("*").alias("n"), F.sum(spent).alias("spent"), F.sum(critical).alias("critical"))
    levels = F.map_from_entries(F.array_sort(F.collect_list(F.struct(level, "n"))))
    n = F.sum("n")
    return by.groupBy(key).agg(n.alias("assessments"), (F.sum("spent") / n).alias("mean"), (F.sum("critical") / F.greatest(n, F.lit(1))).alias("critical_rate"), levels.alias("levels"))
