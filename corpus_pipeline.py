"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's result as Parquet and gives
the next stage what it reads back, so a lost executor costs a stage's tasks and never an earlier stage.

Defined cases, as the operators state them: null, empty and wordless texts are rejected by the first stage, and by the
others if that is left out; rows without a doc_id stay rows of their own, rows of one doc_id with different texts too;
equal rows of one doc_id are one from the third stage on, and ties go to the smallest doc_id. Texts of any length are
taken whole. Columns that documents do not have are dropped by each stage. An empty table gives empty ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from lectern.llm.common import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: failing lines go, then documents that fail or lose too much."""
    return quality_rules.apply_rules(docs).select(*COLUMNS)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: of near-equal lines the earliest stays; documents left without a word go."""
    return line_dedup.without_repeated_lines(docs).select(*COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the document with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as the mix takes it."""
    return mixing.mix(docs).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", clean),
    ("line_dedup", lines_once),
    ("ngram_join", one_of_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: The last stage counts tokens, so SQL cannot give these rows; tests hold them against a plain version.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table goes once the next one is written; the last stays, as it is the result."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            _remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs.select(*[F.col(c) for c in docs.columns])
