"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes of BITS bits: principal axes, then a learned rotation (iterative quantization), fitted on at
most SAMPLE vectors with the smallest hashes; that bound is a parameter, every vector is coded and indexed. A code
is cut into PARTS substrings; each block of up to BLOCK distinct vectors has a table for each substring from its
value to the rows that hold it. A query probes all values within k bits of its own substrings: by the pigeonhole
principle that retrieves every code within PARTS * (k + 1) - 1 bits. What lies within that radius is ranked by
distances in double precision on the original vectors.

k grows from 0 until the radius covers the Hamming distance that SURE of the sample's neighbours stay under at the
distance of the farthest neighbour found so far; so close neighbours end the search early, and vectors without any
structure lead to wide radii, in the end to the whole block: nothing is capped. Queries are sent to the index in
blocks of QUERIES.

Equal vectors are one entry of the index with their NEAREST + 1 smallest vec_ids, which is all a result can name, so
a vector that a third of all rows share costs no more than another. Equal queries are searched once.

Defined cases
    vectors that are null, all zero, hold null, NaN or infinity: take no part. Vectors of several lengths: each is searched
    among those of its own length, with codes of their own.
    null vec_id: takes no part. Repeated rows (same vec_id and vector): one row. Fewer candidates than NEAREST: all.
    ties: smaller vec_id first. Empty table: empty result. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lectern.llm import textvec as tv
from lectern.llm.common import durable, least_hashes, table

BITS, PARTS, NEAREST, SAMPLE, BLOCK, QUERIES, SURE = 64, 4, 10, 6000, 16_384, 1024, 0.97
SUB = BITS // PARTS


class Codes:
    """Learned codes, and which Hamming distance to expect at a distance."""

    def __init__(self, x: np.ndarray, rounds: int = 30):
        rng = np.random.default_rng(3)
        self.mean = x.mean(axis=0)
        z = x - self.mean
        value, vector = np.linalg.eigh(z.T @ z / max(1, len(z)))
        axes = vector[:, ::-1][:, : min(BITS, x.shape[1])]
        # fewer dimensions than bits: further random directions
        extra = rng.normal(size=(x.shape[1], BITS - axes.shape[1])) if axes.shape[1] < BITS else np.zeros((x.shape[1], 0))
        n = axes.shape[1]
        rotation = np.linalg.qr(rng.normal(size=(n, n)))[0]
        p = z @ axes
        for _ in range(rounds if len(x) > 1 else 0):
            u, _, vt = np.linalg.svd(np.where(p @ rotation > 0, 1.0, -1.0).T @ p)
            rotation = vt.T @ u.T
        self.directions = np.hstack([axes @ rotation, extra])
        self._expect(x, self.of(x))

    def of(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.directions > 0
        return np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64)

    def _expect(self, x: np.ndarray, code: np.ndarray) -> None:
        """Steps (distance, Hamming distance that SURE of the neighbours up to it stay under)."""
        square, pairs = (x * x).sum(axis=1), []
        for i in range(0, min(len(x), 1000), 100):
            d = np.maximum(square[i : i + 100, None] + square - 2 * x[i : i + 100] @ x.T, 0)
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            near = np.argsort(d, axis=1)[:, : 2 * NEAREST]
            h = np.bitwise_count(code[i : i + 100, None] ^ code[near])
            pairs.append((np.sqrt(np.take_along_axis(d, near, 1)).ravel(), h.ravel()))
        d, h = (np.concatenate(y) for y in zip(*pairs)) if pairs else (np.zeros(0), np.zeros(0))
        order = np.argsort(d[np.isfinite(d)])
        d, h = d[np.isfinite(d)][order], h[np.isfinite(d)][order]
        groups = [g for g in np.array_split(np.arange(len(d)), max(1, len(d) // 200)) if len(g)]
        self.steps = np.array([d[g[-1]] for g in groups])
        self.bits = np.maximum.accumulate([np.quantile(h[g], SURE) for g in groups]) if groups else np.zeros(0)

    def needed(self, distance: float) -> float:
        """The Hamming radius to search for neighbours up to this distance."""
        k = int(np.searchsorted(self.steps, distance))
        return float(self.bits[k]) if k < len(self.bits) else BITS


_MASKS = [np.array([sum(1 << b for b in c) for c in combinations(range(SUB), k)], np.int64) for k in range(SUB + 1)]


class Index:
    """Substring tables of one block."""

    def __init__(self, x: np.ndarray, code: np.ndarray):
        self.x, self.code = x, code
        self.rows, self.start = [], []
        for s in range(PARTS):
            value = ((code >> np.uint64(SUB * s)) & np.uint64((1 << SUB) - 1)).astype(np.int64)
            order = np.argsort(value, kind="stable")
            self.rows.append(order)
            self.start.append(np.searchsorted(value[order], np.arange((1 << SUB) + 1)))

    def search(self, q: np.ndarray, code: np.uint64, model: Codes, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the nearest found, nearest first."""
        # rows are told apart only once a probe has met them
        met, apart = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        seen, ranked = np.zeros(len(self.x), bool), 0
        rows, distance = np.zeros(0, np.int64), np.zeros(0)
        for k in range(SUB + 1):
            for s in range(PARTS):
                probe = (int(code) >> (SUB * s) & (1 << SUB) - 1) ^ _MASKS[k]
                a, b = self.start[s][probe], self.start[s][probe + 1]
                some = b > a
                owner, at = tv.ragged((b - a)[some])
                found = self.rows[s][a[some][owner] + at]
                found = found[~seen[found]]  # a row has one value in a table
                seen[found] = True
                met, apart = np.concatenate([met, found]), np.concatenate([apart, np.bitwise_count(self.code[found] ^ code)])
            radius = PARTS * (k + 1) - 1
            near = apart <= radius
            new, met, apart = np.sort(met[near]), met[~near], apart[~near]
            ranked += len(new)
            d = self.x[new] - q
            rows, distance = np.concatenate([rows, new]), np.concatenate([distance, np.sqrt((d * d).sum(axis=1))])
            # the count-th place may be shared: all of its distance are kept
            if len(rows) > count:
                keep = distance <= np.partition(distance, count - 1)[count - 1]
                rows, distance = rows[keep], distance[keep]
            if ranked == len(self.x) or len(rows) >= count and radius >= model.needed(float(distance.max())):
                break
        order = np.argsort(distance, kind="stable")
        return rows[order], distance[order]


def _matrix(packed: pa.Array, row: int, width: int) -> np.ndarray:
    return np.frombuffer(packed[row].as_buffer(), "<f4").reshape(-1, width).astype(np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part, each once."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine & F.exists("embedding", lambda x: x != 0))
    return v.distinct()


def blocks(vectors: DataFrame, width: int, size: int) -> DataFrame:
    """block, x: the distinct vectors (key, embedding) in blocks of about that size, packed."""
    n = max(1, -(-vectors.count() // size))
    pack = F.udf(lambda rows: np.array([r.embedding for r in rows], "<f4").tobytes(), "binary")
    dealt = vectors.groupBy(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(n)).alias("block")).agg(F.sort_array(F.collect_list(F.struct("key", "embedding"))).alias("rows"))
    return dealt.select("block", F.col("rows.key").alias("keys"), pack("rows").alias("x"))


def nearest(vectors: DataFrame, every: int = 100, count: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each row whose vec_id is divisible by `every`."""
    schema = "query_id long, rank int, vec_id long, score double"
    good = durable(usable(vectors))
    out = vectors.sparkSession.createDataFrame([], schema)
    for row in good.select(F.size("embedding").alias("w")).distinct().orderBy("w").collect():
        out = out.union(_nearest(good.where(F.size("embedding") == row.w), row.w, every, count))
    return out


def _nearest(good: DataFrame, width: int, every: int, count: int) -> DataFrame:
    """As nearest(), for usable vectors of one length."""
    vectors = good
    good = good.withColumn("key", F.xxhash64("embedding"))
    first = W.partitionBy("key", "embedding").orderBy("vec_id")
    # row_number with a bound is limited within each task before the shuffle
    least = good.withColumn("r", F.row_number().over(first)).where(F.col("r") <= count + 1)
    entries = durable(least.groupBy("key", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    sample = least_hashes(entries, F.xxhash64("key"), "key", SAMPLE).select("embedding").toPandas()
    model = vectors.sparkSession.sparkContext.broadcast(Codes(np.array(sample["embedding"].tolist(), np.float64)))

    asked = good.where(F.col("vec_id") % every == 0).select("vec_id", "key")
    query = blocks(entries.join(asked.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]), width, QUERIES)
    index = durable(blocks(entries, width, BLOCK))
    number = index.count()
    query = query.select("keys", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias("block")).withColumnsRenamed({"keys": "asked", "x": "q"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                if block != now:
                    x = _matrix(batch.column("x"), row, width)
                    now, held = block, (Index(x, model.value.of(x)), np.array(batch.column("keys")[row].as_py(), np.int64))
                built, keys = held
                asked, q = np.array(batch.column("asked")[row].as_py(), np.int64), _matrix(batch.column("q"), row, width)
                out = [[], [], []]
                for k, (v, code) in enumerate(zip(q, model.value.of(q))):
                    rows, d = built.search(v, code, model.value, count + 1)
                    out[0].append(np.full(len(rows), asked[k]))
                    out[1].append(keys[rows])
                    out[2].append(d)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["asked", "key", "score"])

    met = index.join(query, "block")
    found = durable(met.repartition(F.col("block")).sortWithinPartitions("block").mapInArrow(tv.lean(run), "asked long, key long, score double"))
    named = found.join(entries.select("key", F.explode("ids").alias("vec_id")), "key")
    best = W.partitionBy("asked").orderBy("score", "vec_id")
    few = named.withColumn("r", F.row_number().over(best)).where(F.col("r") <= count + 1).select("asked", "vec_id", "score")
    told = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("asked")).join(few, "asked").where("query_id <> vec_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return told.withColumn("rank", rank.cast("int")).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
