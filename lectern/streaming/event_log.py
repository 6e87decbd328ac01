"""A log of progress events that several subscribers read as it grows.

Each micro-batch goes to every sink, into a folder that carries the batch's number. A batch that is run again after a
failure overwrites its own folders, so each event is in each sink once, whatever was written before the stop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Sink = Callable[[DataFrame], DataFrame]


def notifications(events: DataFrame, subscriptions: DataFrame, operation: str = "operation") -> DataFrame:
    """A row for each event and subscriber of its operation; subscriptions (subscriber, operation), a null operation
    standing for all. Sides are joined by the operation, those of all by a broadcast of their names."""
    some = events.join(subscriptions.where(F.col(operation).isNotNull()), operation).select("subscriber", *events.columns)
    every = subscriptions.where(F.col(operation).isNull()).agg(F.collect_set("subscriber").alias("__all"))
    return some.unionByName(events.join(F.broadcast(every)).select(F.explode("__all").alias("subscriber"), *events.columns))


def fan_out(events: DataFrame, sinks: dict[str, Sink], top: str, fail_at: tuple[int, str] | None = None):
    """Runs all that is there now through every sink and returns when it is done; the next call goes on from there.

    fail_at (batch, sink) stops before that write, to try out a restart."""

    def each(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for name, sink in sinks.items():
                if fail_at == (number, name):
                    raise RuntimeError(f"stopped before {name} of batch {number}")
                sink(kept).write.mode("overwrite").parquet(f"{top}/{name}/batch={number}")
        finally:
            kept.unpersist()

    query = events.writeStream.foreachBatch(each).option("checkpointLocation", f"{top}/_progress").trigger(availableNow=True).start()
    query.awaitTermination()


def read(spark: SparkSession, top: str, name: str) -> DataFrame:
    return spark.read.option("basePath", f"{top}/{name}").parquet(f"{top}/{name}/batch=*")


def table_stream(spark: SparkSession, folder: str, name: str, files_at_once: int = 1) -> DataFrame:
    """A Parquet table of a folder as a stream, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    one = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_at_once)
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder) if one else stream.parquet(path)
