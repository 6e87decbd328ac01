"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: a run of anything but ASCII white space. Fixed by the operators' contract.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; only a session on one machine may do without."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{tempfile.gettempdir()}/checkpoints"


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """df cut from its lineage, kept where every executor can read it again (see shared_folder)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}")
    return df.checkpoint(eager)


#: What a broadcast may hold.
BROADCAST_BYTES = 16 << 20


def if_small(df: DataFrame, width: int | Column = 64) -> DataFrame:
    """df with a broadcast hint if it holds at most BROADCAST_BYTES, width being the bytes of a row (a number, or a
    column for rows of any size), else as it is: AQE then splits skewed partitions of a shuffled join. df should be cheap to count, so checkpointed."""
    if isinstance(width, int):
        few = df.limit(BROADCAST_BYTES // width + 1).count() <= BROADCAST_BYTES // width
    else:
        few = (df.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES
    return F.broadcast(df) if few else df


#: Rows of a narrow checkpointed table that one task reads.
TASK_ROWS = 1 << 16


def gathered(df: DataFrame) -> DataFrame:
    """df, checkpointed and of a few numbers a row, read by one task for each TASK_ROWS rows and not by one for each
    partition that it was made in: a small table then costs no exchange over all partitions."""
    return df.coalesce(max(1, -(-df.count() // TASK_ROWS)))


def least_hashes(df: DataFrame, hashed: Column, tie: str, rows: int) -> DataFrame:
    """The `rows` rows with the smallest hashes, df being cheap to count. A hash threshold that a quarter more
    than so many rows meet comes first, so that all tasks together send little more than the result."""
    span = 1 << 30
    share = min(1.0, 1.25 * (rows + 200) / max(1, df.count()))
    return df.where(F.pmod(hashed, F.lit(span)) < int(share * span)).orderBy(F.pmod(hashed, F.lit(span)), tie).limit(rows)
