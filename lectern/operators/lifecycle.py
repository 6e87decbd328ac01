"""Operators on logs and records: errors and their recovery, life cycles, caches, addresses, landed answers, names.

Each takes and returns DataFrames and names its columns by parameters, so it runs on any table that has them.
Times are seconds (long or double); "now" is a parameter or, if none is given, the largest time in the input.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import rules as R


def ladder(arms: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first condition that holds."""
    out = F
    for condition, value in arms:
        out = out.when(condition, value)
    return out.otherwise(otherwise) if arms else otherwise


# ---- errors ----------------------------------------------------------------------------------------


def classified_errors(errors: DataFrame, type_: str = "type", message: str = "message", retries: str = "retries") -> DataFrame:
    """severity, category, strategy, max_retries, factor: by the error's type, else by its message, else the default;
    low and medium rise by one after more than SEVERITY_AFTER_RETRIES retries."""
    low = F.lower(F.coalesce(F.col(message), F.lit("")))
    arms = [(F.col(type_) == t, v) for t, v in R.ERROR_TYPES.items()] + [(F.contains(low, F.lit(m)), v) for m, v in R.ERROR_MESSAGES]
    names = ("severity", "category", "strategy", "max_retries", "factor")
    row = lambda v: F.struct(*[F.lit(x).alias(n) for n, x in zip(names, v)])
    out = errors.withColumn("__rule", ladder([(c, row(v)) for c, v in arms], row(R.ERROR_DEFAULT))).select(*errors.columns, "__rule.*")
    raised = F.when(F.col("severity") == "low", "medium").when(F.col("severity") == "medium", "high").otherwise(F.col("severity"))
    return out.withColumn("severity", F.when(F.col(retries) > R.SEVERITY_AFTER_RETRIES, raised).otherwise(F.col("severity")))


def recovery_plan(errors: DataFrame, retries: str = "retries", base: float = 5.0) -> DataFrame:
    """action and delay (seconds) of classified errors: none left, by hand, from a checkpoint, degraded, or after a delay
    that grows by the strategy."""
    left = F.col(retries) < F.col("max_retries")
    delay = (
        F.when(F.col("strategy") == "immediate_retry", 0.0)
        .when(F.col("strategy") == "linear_backoff", base * F.col("factor") * (F.col(retries) + 1))
        .when(F.col("strategy") == "exponential_backoff", base * F.pow(F.col("factor"), F.col(retries)))
    )
    action = (
        F.when(F.col("strategy") == "manual_intervention", "raise")
        .when(~left, "give_up")
        .when(F.col("strategy") == "checkpoint_restore", "restore")
        .when(F.col("strategy") == "graceful_degradation", "degrade")
        .otherwise("retry")
    )
    return errors.withColumn("action", action).withColumn("delay", F.when(F.col("action") == "retry", F.least(delay, F.lit(R.MOST_DELAY))))


def recovery_attempts(errors: DataFrame, succeeds_at: str, id_: str = "id", retries: str = "retries", base: float = 5.0) -> DataFrame:
    """The attempts that retried errors make, one row each: id, strategy, attempt, delay, success. They go on from the
    retries so far until the one that succeeds (null: none would) or until none is left."""
    last = F.least("max_retries", F.coalesce(succeeds_at, "max_retries"))
    some = recovery_plan(errors, retries, base).where((F.col("action") == "retry") & (last > F.col(retries)))
    told = some.select(id_, "strategy", "factor", "max_retries", F.col(succeeds_at).alias("__at"), F.explode(F.sequence(F.col(retries) + 1, last)).alias("attempt"))
    planned = recovery_plan(told.withColumn("__before", F.col("attempt") - 1), "__before", base)
    return planned.select(id_, "strategy", "attempt", "delay", F.coalesce(F.col("attempt") == F.col("__at"), F.lit(False)).alias("success"))


def recovered(errors: DataFrame, succeeds_at: str, degraded: str, cached: str, id_: str = "id", retries: str = "retries", base: float = 5.0) -> DataFrame:
    """errors with action, value, resolved, attempts and successes: retried ones are resolved by the attempt that succeeds,
    degraded ones by the degraded value or else the cached one; by hand, from a checkpoint or with none left, none is."""
    log = recovery_attempts(errors, succeeds_at, id_, retries, base)
    made = log.groupBy(F.col(id_).alias("__id")).agg(F.count("*").alias("attempts"), F.count_if("success").alias("successes"))
    planned = recovery_plan(errors, retries, base)
    value = F.when(F.col("action") == "degrade", F.coalesce(degraded, cached))
    told = planned.join(made, F.col(id_) == F.col("__id"), "left").drop("__id").withColumn("value", value)
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return told.withColumns({"resolved": (count("successes") > 0) | F.col("value").isNotNull(), "attempts": count("attempts"), "successes": count("successes")})


def error_statistics(errors: DataFrame) -> DataFrame:
    """by, name: errors, those resolved, their share, attempts and successes, of all and by severity, category, strategy."""
    sets = errors.groupingSets([["severity"], ["category"], ["strategy"], []], "severity", "category", "strategy")
    told = sets.agg(
        F.grouping_id().alias("__g"), F.count("*").alias("n"), F.count_if("resolved").alias("resolved"), F.sum("attempts").alias("attempts"), F.sum("successes").alias("successes")
    )
    by = F.when(F.col("__g") == 3, "severity").when(F.col("__g") == 5, "category").when(F.col("__g") == 6, "strategy").otherwise("all")
    return told.select(by.alias("by"), F.coalesce("severity", "category", "strategy", F.lit("")).alias("name"), "n", "resolved", (F.col("resolved") / F.col("n")).alias("rate"), "attempts", "successes")


def background_recovery(errors: DataFrame, at: str = "at", id_: str = "id", most: int = 10) -> DataFrame:
    """Of the latest unresolved light errors those that may recover by themselves, and what becomes of each. The latest
    are taken first, so some of them may drop out."""
    latest = errors.where(F.col("severity").isin("low", "medium") & ~F.col("resolved")).orderBy(F.desc(at), F.desc(id_)).limit(most)
    some = latest.where(F.col("strategy").isin("linear_backoff", "exponential_backoff", "graceful_degradation") & (F.col("retries") < 3))
    return some.withColumn("outcome", F.when(F.col("category") == "rate_limit", "resolved").otherwise("retry"))


# ---- life cycles -----------------------------------------------------------------------------------


def illegal_transitions(log: DataFrame, key: str, order: list[str], state: str, allowed: dict[str, tuple[str, ...]] = R.TRANSITIONS) -> DataFrame:
    """Rows whose state may not follow the state before, with that; what stays as it was is no change."""
    legal = F.array(*[F.lit(f"{a}>{b}") for a, to in allowed.items() for b in to])
    told = log.withColumn("before", F.lag(state).over(W.partitionBy(key).orderBy(*order)))
    step = F.concat("before", F.lit(">"), F.col(state))
    return told.where(F.col("before").isNotNull() & (F.col("before") != F.col(state)) & ~F.array_contains(legal, step))


def restored(checkpoint: DataFrame, current: DataFrame, key: str, mode: str, status: str = "status") -> DataFrame:
    """full: the checkpoint; partial: its completed rows; merge: all rows of both, the checkpoint's where both have one."""
    if mode == "full":
        return checkpoint
    if mode == "partial":
        return checkpoint.where(F.col(status) == "completed")
    if mode != "merge":
        raise ValueError(mode)
    return checkpoint.unionByName(current.join(checkpoint.select(key), key, "left_anti").select(*checkpoint.columns))


def trailing_alerts(log: DataFrame, key: str, at: str, id_: str, value: str, seconds: float, last: int, least: float) -> DataFrame:
    """Per key: mean of its last rows in the trailing span, their number, and whether the mean is too low."""
    now = log.agg(F.max(at).alias("__now"))
    recent = log.crossJoin(F.broadcast(now)).where(F.col(at) > F.col("__now") - F.lit(seconds))
    ranked = recent.withColumn("__k", F.row_number().over(W.partitionBy(key).orderBy(F.desc(at), F.desc(id_)))).where(F.col("__k") <= last)
    return ranked.groupBy(key).agg(F.round(F.avg(value), 6).alias("mean"), F.count("*").alias("n"), (F.avg(value) < least).alias("alert"))


def recent_rates(log: DataFrame, key: str, at: str, id_: str, value: str, last: int = 5) -> DataFrame:
    """Per key: change of value over time between the first and the last of its latest rows; 0 if no time passed."""
    ranked = log.withColumn("__k", F.row_number().over(W.partitionBy(key).orderBy(F.desc(at), F.desc(id_)))).where(F.col("__k") <= last)
    ends = ranked.groupBy(key).agg(*[f(F.struct(at, value), "__k").alias(n) for f, n in ((F.min_by, "z"), (F.max_by, "a"))])
    time = F.col(f"z.{at}") - F.col(f"a.{at}")
    return ends.select(key, F.when(time > 0, (F.col(f"z.{value}") - F.col(f"a.{value}")) / time).otherwise(F.lit(0.0)).alias("rate"))


# ---- caches ----------------------------------------------------------------------------------------


def cache_hours(kind: str) -> Column:
    return ladder([(F.col(kind) == k, F.lit(h)) for k, h in R.CACHE_HOURS.items()], F.lit(R.OTHER_HOURS))


def stale_entries(cache: DataFrame, kind: str, created: str, accessed: str, now: Column, hash_: str, current_hash: str, uses: str, full: Column) -> DataFrame:
    """Entries that are no longer valid, and the first reason: time, age, content, or size (full: whether the cache is)."""
    age = (now - F.col(created)) / 3600.0
    reason = (
        F.when(age > cache_hours(kind), "time")
        .when(age > R.MOST_HOURS, "age")
        .when(F.col(current_hash).isNotNull() & (F.col(current_hash) != F.col(hash_)), "content")
        .when(full & ((F.col(uses) <= 0) | ((now - F.col(accessed)) / 3600.0 > R.UNUSED_HOURS)), "size")
    )
    return cache.withColumn("reason", reason).where(F.col("reason").isNotNull())


def cache_hits(log: DataFrame, key: str, kind: str, at: str, order: list[str], is_set: str) -> DataFrame:
    """Per kind: gets that find an entry set before and still valid, gets that do not, and sets."""
    before = W.partitionBy(key, kind).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    told = log.withColumn("__set", F.last(F.when(F.col(is_set), F.col(at)), ignorenulls=True).over(before))
    hit = ~F.col(is_set) & F.coalesce(F.col(at) - F.col("__set") <= cache_hours(kind) * 3600.0, F.lit(False))
    return told.groupBy(kind).agg(F.count_if(hit).alias("hits"), F.count_if(~F.col(is_set) & ~hit).alias("misses"), F.count_if(is_set).alias("sets"))


def running_total(df: DataFrame, size: str, order: list[str], buckets: int = 1024) -> DataFrame:
    """df with `upto`: the sum of size over the rows up to each in that order. The first order column is a number; its
    range is cut into buckets, whose sums are run over in one task, and each bucket is summed by itself."""
    edge = df.agg(F.min(order[0]).cast("double").alias("lo"), F.max(order[0]).cast("double").alias("hi"))
    span = F.when(F.col("hi") > F.col("lo"), (F.col(order[0]).cast("double") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(F.lit(0.0))
    dealt = df.crossJoin(F.broadcast(edge)).withColumn("__b", F.least(F.floor(span * buckets), F.lit(buckets - 1)).cast("int")).drop("lo", "hi")
    sums = dealt.groupBy("__b").agg(F.sum(size).alias("__n"))
    before = sums.select("__b", F.coalesce(F.sum("__n").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    within = F.sum(size).over(W.partitionBy("__b").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return dealt.withColumn("__in", within).join(F.broadcast(before), "__b").withColumn("upto", F.col("__in") + F.col("__before")).drop("__b", "__in", "__before")


def integrity_errors(blobs: DataFrame, data: str, size: str, hash_: str) -> DataFrame:
    """errors: what the stored size and hash of each blob get wrong, empty if nothing."""
    n, sha = F.octet_length(data), F.sha2(F.col(data).cast("binary"), 256)
    wrong = F.concat_ws("; ", F.when(n != F.col(size), "size"), F.when(sha != F.col(hash_), "hash"))
    return blobs.withColumn("errors", wrong)


# ---- addresses and names ---------------------------------------------------------------------------


def url_kind(url: str) -> Column:
    low = F.lower(url)
    arms = [(F.col(url).rlike(p), F.lit(k)) for k, p in R.URL_PATTERNS]
    for kind, words in R.URL_WORDS:
        some = F.lit(False)
        for w in words:
            some = some | F.contains(low, F.lit(w))
        arms.append((some, F.lit(kind)))
    return ladder(arms, F.lit("other"))


def url_parts(urls: DataFrame, url: str) -> DataFrame:
    """language, format and title as a document's address tells them; null where it does not."""
    path = F.regexp_replace(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), r";[^/]*$", "")
    parts = F.split(path, "/")
    extension = F.lower(F.element_at(F.split(path, r"\."), -1))
    name = F.element_at(parts, -1)
    title = F.initcap(F.translate(F.element_at(F.split(name, r"\."), 1), "-_", "  "))
    language = F.upper(F.get(F.filter(parts, lambda p: p.rlike(r"^\p{L}{2}$")), F.lit(0)))
    return urls.select("*", language.alias("language"), F.when(F.contains(path, F.lit(".")) & extension.isin(*R.URL_FORMATS), extension).alias("format"), F.when(name != "", title).alias("title"))


def session_name(name: str) -> dict[str, Column]:
    """The parts that a session's name tells by the first pattern that it begins with, else its id."""
    out = {}
    for field in ("type", "term", "year", "month", "day", "session"):
        arms = [(F.col(name).rlike(p), F.regexp_extract(name, p, groups.index(field) + 1) if field in groups else F.lit(None).cast("string")) for p, groups in R.SESSION_NAMES]
        out[field] = ladder(arms, F.lit(None).cast("string"))
    known = F.lit(False)
    for p, _ in R.SESSION_NAMES:
        known = known | F.col(name).rlike(p)
    out["id"] = F.when(~known, F.col(name))
    return out


def normalized_speaker(raw: str) -> Column:
    """A speaker's name by the first pattern that fits: President, Commissioner X, member, rapporteur; else without titles."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.col(raw), r"<[^>]+>", ""), r"\s+", " "))
    clean = F.translate(clean, "–—", "--")
    arms = [(clean.rlike(R.PRESIDENT), F.lit("President"))]
    arms += [(clean.rlike(p), F.concat(F.lit(prefix), F.initcap(F.trim(F.regexp_extract(clean, p, 1))))) for prefix, p in R.NAMED_SPEAKERS]
    plain = clean
    for p in R.SPEAKER_TITLES:
        plain = F.trim(F.regexp_replace(plain, p, ""))
    name = ladder(arms, F.when(plain != "", F.initcap(F.regexp_replace(plain, r"\s+", " "))).otherwise(F.trim(raw)))
    return F.when(F.length(F.trim(F.coalesce(F.col(raw), F.lit("")))) < 2, F.lit("")).otherwise(name)


def speaker_paragraphs(texts: DataFrame, text: str) -> DataFrame:
    """speaker and speech of texts that begin with a speaker, white space collapsed, and three signs of quality."""
    flat = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))
    some = texts.withColumn("__flat", flat).where((F.length("__flat") >= R.LEAST_SEGMENT) & F.col("__flat").rlike(R.SPEECH_START))
    out = some.withColumn("speaker", F.trim(F.regexp_extract("__flat", R.SPEECH_START, 1))).withColumn("speech", F.trim(F.regexp_extract("__flat", R.SPEECH_START, 2))).drop("__flat")
    marks = F.contains("speech", F.lit(".")) | F.contains("speech", F.lit("?"))
    return out.withColumns({"has_speaker": F.col("speaker") != "", "long_enough": F.length("speech") >= R.LEAST_SEGMENT, "proper": marks})


def announcement_scores(segments: DataFrame, text: str, role: str) -> DataFrame:
    """A score for each class of announcements, the best score (confidence), whether it is one, and its class (of equal
    scores the first). Null texts and roles count as empty."""
    low, who = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in (text, role))
    out = segments.withColumns({"__low": low, "__who": who, "__words": F.regexp_count(low, F.lit(r"\S+"))})
    number = lambda tests: sum((t.cast("double") for t in tests), F.lit(0.0))
    for name, (patterns, roles, context, short) in R.ANNOUNCEMENT_RULES.items():
        met = F.least(F.lit(0.5), number([F.col("__low").rlike(p) for p in patterns]) * 0.2)
        said = F.when(number([F.contains("__who", F.lit(r)) for r in roles]) > 0, 0.3).otherwise(0.0)
        brief = F.when(F.col("__words") < short, 0.2).otherwise(0.0)
        near = F.least(F.lit(0.3), number([F.contains("__low", F.lit(w)) for w in context]) * 0.1)
        out = out.withColumn(name, F.least(F.lit(1.0), met + said + brief + near))
    names = list(R.ANNOUNCEMENT_RULES)
    best = F.greatest(*names)
    label = ladder([(F.col(n) == F.col("confidence"), F.lit(n)) for n in names[:-1]], F.lit(names[-1]))
    told = out.drop("__low", "__who", "__words").withColumn("confidence", best).withColumn("is_announcement", F.col("confidence") > R.ANNOUNCEMENT_FROM)
    return told.withColumn("label", F.when(F.col("is_announcement"), label))


def contains_join(texts: DataFrame, text: str, needles: DataFrame, needle: str, n: int = 3) -> DataFrame:
    """texts with each needle that they contain, both in lower case. A text meets a needle by that of the needle's
    pieces of n characters which the fewest texts hold (a needle of fewer characters is its own piece), so a piece that
    all texts share is no key unless a needle has no other. Null texts and needles meet nothing, empty needles all texts."""
    low, own = F.lower(F.col(text)), F.lower(F.col(needle))
    cut = lambda s, k: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: F.substring(s, i, k)))
    sized = needles.where(F.length(own) > 0).withColumn("__size", F.least(F.length(own), F.lit(n)))
    pieces = sized.select(F.col(needle), F.explode(cut(own, F.col("__size"))).alias("__piece")).distinct()
    sizes = [r[0] for r in sized.select("__size").distinct().collect()]  # n numbers at most
    held = F.array_distinct(F.flatten(F.array(*(F.when(F.length(low) >= k, cut(low, F.lit(k))).otherwise(F.array().cast("array<string>")) for k in sizes))) if sizes else F.array().cast("array<string>"))
    left = texts.withColumn("__held", F.explode(held))
    known = left.join(pieces.select(F.col("__piece").alias("__held")).distinct(), "__held", "left_semi")
    counts = known.groupBy(F.col("__held").alias("__piece")).agg(F.count("*").alias("__n"))
    rarest = pieces.join(counts, "__piece").groupBy(needle).agg(F.min(F.struct("__n", "__piece"))["__piece"].alias("__key"))
    keyed = needles.join(rarest.select(F.col(needle).alias("__needle"), "__key"), F.col(needle) == F.col("__needle")).drop("__needle")
    met = known.join(keyed, F.col("__held") == F.col("__key")).where(F.contains(low, own)).drop("__held", "__key")
    every = needles.where(F.length(own) == 0)
    return met.unionByName(texts.where(low.isNotNull()).join(every, F.length(low) >= F.length(own)))


# ---- landed answers --------------------------------------------------------------------------------


def unwrapped(answers: DataFrame, column: str, schema: str) -> DataFrame:
    """One row for each result of JSON answers, {"results": [...]} or a bare list; others have none."""
    wrapped = F.from_json(column, f"results array<struct<{schema}>>")["results"]
    bare = F.from_json(column, f"array<struct<{schema}>>")
    rows = F.when(F.ltrim(column).startswith("["), bare).otherwise(wrapped)
    kept = [c for c in answers.columns if c != column]
    return answers.select(*kept, F.explode(rows).alias("__r")).select(*kept, "__r.*")


def bindings(answers: DataFrame, column: str, names: list[str]) -> DataFrame:
    """One row for each binding of query answers, one column for each variable, null where it is unbound."""
    rows = F.from_json(column, "results struct<bindings array<map<string, struct<type string, value string>>>>")["results"]["bindings"]
    kept = [c for c in answers.columns if c != column]
    return answers.select(*kept, F.explode(rows).alias("__b")).select(*kept, *[F.col("__b")[n]["value"].alias(n) for n in names])


def property_pivot(triples: DataFrame, subject: str, property_: str, value: str, names: list[str], order: str) -> DataFrame:
    """One row for each subject, one column for each property by its name behind the last # or else the last /; of several
    values that of the last row."""
    local = F.when(F.contains(property_, F.lit("#")), F.substring_index(property_, "#", -1)).otherwise(F.substring_index(property_, "/", -1))
    return triples.groupBy(subject).agg(*[F.max_by(value, F.when(local == n, F.col(order))).alias(n) for n in names])


def three_places(value: Column) -> Column:
    """value with three digits after the point, rounded by its exact binary value, as C and SQL's format do; Java rounds the
    shortest decimal, so what prints as 0.0305 but lies below it would go up."""

    @F.pandas_udf("string")
    def written(s: pd.Series) -> pd.Series:
        return s.map("{:.3f}".format)

    return F.when(value.isNull(), "null").otherwise(written(value))


def validation_report(summary: DataFrame, key: str) -> DataFrame:
    """key, report: a text for each row of counts (n, passed, warned, failed, score, severities map)."""
    rows = F.transform(F.array_sort(F.map_entries("severities")), lambda e: F.concat(F.lit("  "), F.upper(e["key"]), F.lit(": "), e["value"].cast("string")))
    line = lambda name, value: F.concat(F.lit(f"  {name}: "), value)
    parts = [
        F.lit("SUMMARY:"),
        line("Overall Status", F.when(F.col("failed") == 0, "PASS").otherwise("FAIL")),
        line("Quality Score", three_places(F.col("score"))),
        line("Total Segments", F.col("n").cast("string")),
        line("Passed", F.col("passed").cast("string")),
        line("With Warnings", F.col("warned").cast("string")),
        line("With Errors", F.col("failed").cast("string")),
        F.lit(""),
        F.when(F.size("severities") > 0, F.concat(F.lit("ISSUES BY SEVERITY:\n"), F.array_join(rows, "\n"))),
    ]
    return summary.select(key, F.concat_ws("\n", *parts).alias("report"))
