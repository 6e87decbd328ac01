"""Stores that a job keeps between runs: versions of a table (checkpoints), and a cache whose entries expire.

Both are folders in a file system that Spark reaches. What is written counts from the moment its manifest or partition
is renamed into place, so a writer that is lost leaves what stood before.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GONE = "__gone"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for `name` where the cluster keeps what driver and executors share; a session on one machine may do
    with its own."""
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{top or tempfile.gettempdir() + '/lectern'}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """df as written to a shared folder, so that what follows plans from there and a lost executor costs no more."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Files:
    """A few calls of Hadoop's file systems, for any scheme."""

    def __init__(self, spark: SparkSession, top: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(top).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Writes beside and renames, so a reader sees all of it or nothing; FileExistsError if another was first."""
        beside = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.path(beside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(self.path(beside), self.path(name)):
            self.remove(beside)
            raise FileExistsError(name)

    def remove(self, name: str) -> bool:
        return self.fs.delete(self.path(name), True)


class Checkpoints:
    """Versions of tables by name: `top/name/data/<folder>` holds rows, `top/name/versions/<n>.json` names the folders
    of version n in the order in which they apply, a whole table first and changes after it.

    Keys are not null and unique in what is saved."""

    def __init__(self, spark: SparkSession, top: str):
        self.spark, self.top, self.files = spark, top, Files(spark, top)

    def versions(self, name: str) -> list[int]:
        return sorted(int(x[: -len(".json")]) for x in self.files.names(f"{self.top}/{name}/versions") if x.endswith(".json"))

    def manifest(self, name: str, version: int | None = None) -> dict:
        known = self.versions(name)
        if not known or (version is not None and version not in known):
            raise KeyError((name, version))
        return json.loads(self.files.read(f"{self.top}/{name}/versions/{version or known[-1]}.json"))

    def list(self) -> DataFrame:
        """name, version, kind, n_parts of all that is stored, newest versions first."""
        rows = [(n, v, m["kind"], len(m["parts"])) for n in self.files.names(self.top) for v in self.versions(n) for m in [self.manifest(n, v)]]
        return self.spark.createDataFrame(rows, "name string, version int, kind string, n_parts int").orderBy("name", F.desc("version"))

    def _write(self, name: str, rows: DataFrame, key: str, kind: str, before: list[str], version: int) -> int:
        folder = f"{kind}-{version}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.top}/{name}/data/{folder}")
        self.files.publish(f"{self.top}/{name}/versions/{version}.json", json.dumps({"version": version, "kind": kind, "key": key, "parts": [*before, folder]}))
        return version

    def _next(self, name: str) -> int:
        return max(self.versions(name), default=0) + 1

    def save(self, name: str, table: DataFrame, key: str) -> int:
        """The whole table as a new version."""
        return self._write(name, table.withColumn(GONE, F.lit(False)), key, "full", [], self._next(name))

    def save_changes(self, name: str, table: DataFrame, key: str) -> int:
        """A new version that stores what differs from the latest: new and changed rows, and the keys that are gone."""
        latest = self.manifest(name)
        before = self.load(name)
        values = [c for c in table.columns if c != key]
        old, new = (F.struct(*(F.col(f"{s}.{c}") for c in values)) for s in ("o", "n"))
        met = before.alias("o").join(table.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
        gone = F.col(f"n.{key}").isNull()
        changed = met.where(gone | F.col(f"o.{key}").isNull() | ~old.eqNullSafe(new))
        pick = lambda c: F.when(gone, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
        return self._write(name, changed.select(*map(pick, table.columns), gone.alias(GONE)), key, "changes", latest["parts"], latest["version"] + 1)

    def load(self, name: str, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest if none is named. One part is read as it stands; of several the last row
        of each key counts, taken with map-side combination."""
        told = self.manifest(name, version)
        parts = [self.spark.read.parquet(f"{self.top}/{name}/data/{p}").withColumn("__part", F.lit(k)) for k, p in enumerate(told["parts"])]
        if len(parts) == 1:
            return parts[0].drop(GONE, "__part")
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        columns = [c for c in rows.columns if c not in (GONE, "__part")]
        last = rows.groupBy(told["key"]).agg(F.max_by(F.struct(*columns, GONE), "__part").alias("__r"))
        return last.where(~F.col(f"__r.{GONE}")).select(*(F.col(f"__r.{c}").alias(c) for c in columns))

    def restore(self, name: str, current: DataFrame, mode: str, version: int | None = None, done: Column | None = None) -> DataFrame:
        """full: the version's rows; partial: those that are done; merge: and rows of `current` whose key it lacks;
        incremental: `current` with the version's rows that are new or differ."""
        saved, key = self.load(name, version), self.manifest(name, version)["key"]
        if mode == "full":
            return saved
        if mode == "partial":
            return saved.where(done)
        if mode in ("merge", "incremental"):
            return saved.unionByName(current.join(saved.select(key), key, "left_anti").select(*saved.columns))
        raise ValueError(mode)

    def compact(self, name: str) -> int:
        return self.save(name, self.load(name), self.manifest(name)["key"])

    def delete(self, name: str, version: int | None = None) -> None:
        """A version, or all of a name; then folders that no version names any more."""
        if version is None:
            self.files.remove(f"{self.top}/{name}")
            return
        self.files.remove(f"{self.top}/{name}/versions/{version}.json")
        used = {p for v in self.versions(name) for p in self.manifest(name, v)["parts"]}
        for folder in self.files.names(f"{self.top}/{name}/data"):
            if folder not in used:
                self.files.remove(f"{self.top}/{name}/data/{folder}")


class Cache:
    """Entries (key, kind, value, created), `shards` partitions by the key's hash; an entry is valid for its kind's hours.

    put() rewrites the partitions that its entries fall into and leaves the files of all others as they are."""

    COLUMNS = ["key", "kind", "value", "created"]

    def __init__(self, spark: SparkSession, top: str, hours: Callable[[str], Column], shards: int = 64):
        self.spark, self.top, self.hours, self.shards, self.files = spark, top, hours, shards, Files(spark, top)

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("kind", "key"), F.lit(self.shards)).cast("int").alias("shard")

    def entries(self) -> DataFrame:
        if not any(x.startswith("shard=") for x in self.files.names(self.top)):
            return self.spark.createDataFrame([], "key string, kind string, value string, created double, shard int")
        return self.spark.read.schema("key string, kind string, value string, created double, shard int").parquet(self.top)

    def valid(self, now: float) -> DataFrame:
        return self.entries().where((F.lit(now) - F.col("created")) / 3600.0 <= self.hours("kind")).drop("shard")

    def put(self, entries: DataFrame, now: float) -> None:
        """Newer entries win, equal times the greater value; what has expired in a rewritten partition goes."""
        new = entries.select(*self.COLUMNS, self._shard())
        staged = f"{self.top}/_staged-{uuid.uuid4().hex}"
        new.write.parquet(staged)
        new = self.spark.read.parquet(staged)
        touched = new.select("shard").distinct()
        kept = self.entries().join(F.broadcast(touched), "shard", "left_semi").where((F.lit(now) - F.col("created")) / 3600.0 <= self.hours("kind"))
        rows = kept.unionByName(new).groupBy("shard", "kind", "key").agg(F.max(F.struct("created", "value")).alias("__r"))
        merged = f"{staged}-merged"
        rows.select("key", "kind", "__r.value", "__r.created", "shard").write.parquet(merged)
        # Staged first: a partition is not overwritten while it is read. A shard is one task's file.
        out = self.spark.read.parquet(merged).repartition("shard")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(self.top)
        self.files.remove(staged)
        self.files.remove(merged)

    def through(self, requests: DataFrame, compute: Callable[[DataFrame], DataFrame], now: float) -> DataFrame:
        """requests (key, kind) with value and hit; what is not there or no longer valid is computed once and stored."""
        wanted = requests.select("key", "kind").distinct()
        known = self.valid(now)
        missing = wanted.join(known.select("key", "kind"), ["key", "kind"], "left_anti")
        folder = f"{self.top}/_hits-{uuid.uuid4().hex}"
        wanted.join(known.select("key", "kind"), ["key", "kind"], "left_semi").write.parquet(folder)
        self.put(compute(missing).withColumn("created", F.lit(float(now))), now)
        hits = self.spark.read.parquet(folder).withColumn("hit", F.lit(True))
        told = requests.join(self.valid(now).select("key", "kind", "value"), ["key", "kind"], "left")
        return told.join(hits, ["key", "kind"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


