"""What each filter of a chain removes, in every order of the chain.

A document's failures are one bit mask. Documents are counted by (part, mask), so at most 2**filters cells of a part
are left whatever the size of the table. Cells are unpivoted against the steps of every order: a running bit-or window
over the steps before tells which documents an earlier filter has removed, conditional sums give the metrics of a step,
and a window over a filter's rows of all orders gives its total.

Copies: texts are compared by their SHA-256. Rows of one text are summed before they meet, so a text that a third of
all documents share costs a row for each task; rows without an id, and labels, are joined on keys that AQE can split.

Defined cases
    null text: as the empty text, so copies of each other. Null part: the empty string.
    null doc_id: has no smaller id, so never a copy, nor makes one; it has no label.
    repeated rows: each counts; rows of one doc_id and text are no copies of each other.
    a doc_id with several labels: a label holds if any of its rows says so. Null labels count as 0.
    one filter after another: every part has a row for each order and step, zeros included.
    empty table: empty result. Columns other than those named: ignored.
"""

from __future__ import annotations

import functools
import itertools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import if_small, let, table, words_of

#: Filters on one text; a letter names each, and fails where the condition holds.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
COPY = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions that one text decides, by letter; text is not null."""
    distinct = let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    return {
        "A": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) < LEAST_WORDS,
        "B": let(distinct, lambda x: 100 * x["d"] < LEAST_DISTINCT * x["n"]),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def bits(letters: str) -> dict[str, int]:
    return {c: 1 << k for k, c in enumerate(letters)}


def masked(docs: DataFrame, part: str = "lang", filters=text_filters) -> tuple[DataFrame, str]:
    """doc_id, part, mask, text_key and how many rows are alike; and the filters' letters in the order of their bits,
    the last being COPY, whose bit is not set yet."""
    text = F.coalesce(F.col("text"), F.lit(""))
    failed = filters(text)
    letters = "".join(failed) + COPY
    bit = bits(letters)
    mask = functools.reduce(operator.add, (F.when(c, F.lit(bit[x])).otherwise(F.lit(0)) for x, c in failed.items()))
    rows = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), mask.cast("int").alias("mask"), F.unhex(F.sha2(text, 256)).alias("text_key"))
    return rows.groupBy("doc_id", "part", "mask", "text_key").agg(F.count("*").alias("n")), letters


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang", filters=text_filters) -> tuple[DataFrame, str]:
    """part, mask, n, n_good, n_toxic: documents of each mask of a part, all of them and those with either label."""
    rows, letters = masked(docs, part, filters)
    label = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    said = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    told = rows.join(if_small(label, 32), "doc_id", "left").select("doc_id", "part", "mask", "text_key", "n", said("good"), said("toxic"))
    # One row for each text, part and label; of its documents only those with the text's smallest id are no copies.
    few = told.groupBy("text_key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("at_first")
    )
    least = F.min("first").over(W.partitionBy("text_key"))
    fewer = few.withColumn("least", least).withColumn("own", F.col("nameless") + F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0))
    copy = bits(letters)[COPY]
    split = fewer.select(
        "part", "good", "toxic", F.inline(F.array(F.struct(F.col("mask"), F.col("own").alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("own")).alias("n"))))
    ).where("n > 0")
    where = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), where("good").alias("n_good"), where("toxic").alias("n_toxic")), letters


def steps(cells: DataFrame, letters: str) -> DataFrame:
    """The metrics of every step of every order of the filters, in each part."""
    orders = F.array(*(F.lit("".join(o)) for o in itertools.permutations(letters)))
    long = cells.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    bit = F.element_at(F.create_map(*(F.lit(x) for pair in bits(letters).items() for x in pair)), F.col("filter"))
    before = W.partitionBy("part", "filter_order", "mask").orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    judged = (
        long.withColumn("filter", letter)
        .withColumn("own", bit)
        .withColumn("fails", F.col("mask").bitwiseAND(F.col("own")))
        .withColumn("earlier", F.coalesce(F.bit_or("fails").over(before), F.lit(0)))
    )
    fails, gone = F.col("fails") != 0, F.col("earlier") != 0
    total = lambda what, when: F.sum(F.when(when, F.col(what)).otherwise(0))
    metrics = judged.groupBy("part", "filter_order", "step", "filter").agg(
        total("n", ~fails & ~gone).alias("kept"),
        total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"),
        total("n", F.col("mask") == F.col("own")).alias("unique_fails"),
        total("n_good", fails & ~gone).alias("good_lost"),
        total("n_toxic", fails & ~gone).alias("toxic_lost"),
    )
    return metrics.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "filter"))).drop("filter")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", filters=text_filters) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return steps(*cells(docs, labels, part, filters))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The masks are spelled out for each order by the letters that stand before a step, without windows over steps.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT part, coalesce(l.good, false) AS good, coalesce(l.bad, false) AS bad,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (bad) AS b FROM m GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, k::INT AS step, substr(filter_order, k, 1) AS f, substr(filter_order, 1, k - 1) AS earlier
  FROM o, generate_series(1, 5) g(k)),
r AS (SELECT part, filter_order, step, f,
    sum(CASE WHEN fails = '' OR NOT regexp_matches(fails, '[' || earlier || f || ']') THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, f) AND NOT (earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]')) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]') THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND NOT (earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]')) THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND NOT (earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]')) THEN b ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""
