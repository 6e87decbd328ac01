"""Mixing sources to target weights by hash thresholds, without sorting documents.

Each document has a 60-bit hash of its id and text. Its source's target is met by whole passes over the source
plus the documents under one hash threshold. The threshold is found from histograms: token sums by
(source, top ten bits), whose running sums name one boundary bucket per source; only that bucket's rows
are summed again by the next ten bits, and so on. Nothing is sorted but at most 1024 sums per source.

Defined cases
    null or empty text: size 0, taken 0. Null source: a source of its own, last in order.
    null doc_id: hashes like an empty id, so it takes part as any other row.
    repeated rows: rows of one doc_id and text share a hash and are taken together or not at all.
    sources without any word: target 0. No words at all: every target 0.
    empty table: empty result. Extra columns: ignored by plan(), carried by mix().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import WORD, durable, fresh, if_small, table

WEIGHTS, MOST = (5, 2, 1), 3
LEVELS, BITS = 3, 10
TOP = 60


def doc_hash(doc_id: Column, text: Column) -> Column:
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target; one row per source. The level all uncapped sources share is found in
    one pass over the sources in the order in which they reach their cap; it takes one task, one row per source."""
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    w = by.withColumn("weight", weights.cast("double")).withColumn("cap", F.col("source_size") * F.lit(MOST))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, W.unboundedFollowing)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    # Levels fall from the first source on that stays under its cap, so the highest that stands is that source's.
    stands = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    return (
        w.withColumn("level", level)
        .withColumn("shared", F.max(stands).over(every))
        .select(
            "source",
            "source_size",
            F.when(F.col("shared").isNull(), F.col("cap").cast("double"))
            .otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("shared")))
            .alias("target"),
        )
    )


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _boundary(rows: DataFrame, budget: DataFrame, shift: int) -> DataFrame:
    """Per source, the bucket (hash >> shift) in which the running sum passes the rest; with what lies before it.

    budget: source, rest, floor. rows: those of the boundary bucket so far.
    """
    bucket = F.shiftright("h", shift)
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
    run = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    told = sums.withColumn("upto", F.sum("n").over(run)).alias("s").join(
        if_small(budget).alias("b"), _same(F.col("s.source"), F.col("b.source"))
    )
    over = told.where(F.col("s.upto") > F.col("b.rest"))
    return over.groupBy(F.col("s.source").alias("source")).agg(
        F.min_by(
            F.struct(F.col("s.bucket").alias("bucket"), (F.col("b.rest") - (F.col("s.upto") - F.col("s.n"))).alias("rest"), F.col("s.n").alias("n")),
            F.col("s.bucket"),
        ).alias("x")
    ).select("source", "x.bucket", "x.rest", "x.n")


def _sized() -> list[Column]:
    return [F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"), doc_hash(F.col("doc_id"), F.col("text")).alias("h")]


def goals(rows: DataFrame) -> DataFrame:
    """source, source_size, target, passes: whole passes that the mix takes, cut: the largest hash it takes once more
    (null: all); rows: source, size, h, cut from their lineage. One row per source."""
    told = durable(
        targets(rows)
        .withColumn("passes", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    )
    left, budget = rows.where("size > 0"), told.where("rest > 0").select("source", "rest")
    for level in range(1, LEVELS + 1):
        shift = TOP - BITS * level
        edge = durable(_boundary(left, budget, shift))
        left = left.alias("r").join(
            if_small(edge).alias("e"), _same(F.col("r.source"), F.col("e.source")) & (F.shiftright(F.col("r.h"), shift) == F.col("e.bucket")), "left_semi"
        )
        left = durable(left) if level == 1 else left
        budget = edge.select("source", "rest")
    # what is left of a source now lies in one bucket of 2**30: sum it by whole hashes
    last = _boundary(left, budget, 0)
    cut = last.select(
        "source",
        # the hash that crosses the budget is taken if that comes nearer to it
        F.when(F.col("n") - F.col("rest") < F.col("rest"), F.col("bucket")).otherwise(F.col("bucket") - 1).alias("cut"),
    )
    return durable(
        told.alias("g").join(cut.alias("c"), _same(F.col("g.source"), F.col("c.source")), "left").select(
            "g.source", "g.source_size", "g.target", "g.passes", F.when(F.col("g.rest") > 0, F.col("c.cut")).otherwise(F.lit(-1)).alias("cut")
        )
    )


def _times(hash_: Column) -> Column:
    """How often a row with this hash is taken, by the columns of goals."""
    under = F.when(F.col("t.cut").isNull() | (hash_ <= F.col("t.cut")), F.lit(1)).otherwise(F.lit(0))
    return F.col("t.passes") + F.when(F.col("t.passes") >= MOST, F.lit(0)).otherwise(under)


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source, source_size, target, taken of every row."""
    rows = durable(docs.select("doc_id", "source", *_sized()))
    met = rows.alias("d").join(if_small(goals(rows)).alias("t"), _same(F.col("d.source"), F.col("t.source")))
    return met.select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target", (F.col("d.size") * _times(F.col("d.h"))).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """docs with each row as often as the mix takes it; the columns stay. Rows without a word are not taken."""
    told = goals(durable(docs.select("source", *_sized())))
    hash_, copy = fresh(docs, "hash"), fresh(docs, "copy")
    met = docs.where(F.col("text").rlike(WORD)).withColumn(hash_, _sized()[1]).alias("d").join(if_small(told).alias("t"), _same(F.col("d.source"), F.col("t.source")))
    times = _times(F.col(f"d.{hash_}"))
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    return met.where(times > 0).select(*columns, F.explode(F.sequence(F.lit(1), times.cast("int"))).alias(copy)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(table(spark, sf_dir, "documents")).drop("source")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS ss, 3 * sum(size)::DOUBLE AS cap,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY source),
r AS (SELECT *, sum(ss) OVER () AS total,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM s),
v AS (SELECT max((total - used) / free) FILTER ((total - used) / free * weight <= cap) AS share FROM r),
t AS (SELECT source, ss, CASE WHEN share IS NULL THEN cap ELSE least(cap, weight * share) END AS target FROM r, v),
p AS (SELECT *, CASE WHEN ss > 0 THEN least(floor(target / ss), 3) ELSE 0 END AS passes FROM t),
q AS (SELECT d.*, p.ss, p.target, p.passes, p.target - p.passes * p.ss AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY d.source, h) AS own FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, ss::BIGINT AS source_size, target,
  (size * (passes + CASE WHEN passes >= 3 OR rest <= 0 THEN 0 WHEN upto <= rest THEN 1
     WHEN upto - own <= rest AND upto - rest < rest - (upto - own) THEN 1 ELSE 0 END))::BIGINT AS taken FROM q
"""
