"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Tokens are runs of letters and digits, or of other visible characters, in lower case and hashed to BUCKETS; a token
equal to the one before is the token "again". Random indexing gives each bucket a fixed sparse random vector of
DIMENSIONS, and its word vector is the sum of those of its neighbours up to REACH tokens away, over all documents.
Each task sums its own texts into one table of fixed size, so the shuffle is that table times the tasks, and the
finished table (BUCKETS x DIMENSIONS) is the same small size for any corpus.

A document's vector pools its tokens' word vectors: their means and deviations over the whole text.
A network of one hidden layer is fitted by Adam in numpy on at most SAMPLE labelled documents (the
smallest hashes of doc_id; the bound is a parameter); a tenth of them is kept to fit the temperature that
calibrates its probabilities.

Defined cases
    null, empty or tokenless text: the zero vector; scored by the network like any other.
    null or contradicting labels: null ones are ignored, of several for one doc_id the mean is rounded, a tie counts as 1.
    no usable label, or one class only: score is the smoothed share of label 1 for every document (0.5 without labels).
    null doc_id: never learned from, hashed like an empty id. Repeated rows: scored alike; one text is learned from, of several under one doc_id that whose features are first as bytes.
    very long texts: whole, in one chunk. Empty table: empty result. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textvec as tv
from lectern.llm.common import durable, if_small, least_hashes, table

BUCKETS, DIMENSIONS, REACH, SAMPLE, HIDDEN, STEPS, BLOCKS = 1 << 13, 32, 2, 20_000, 32, 900, 16
U = tv.U

_CLASS = np.full(256, 2, np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
for _b in range(256):
    if _b >= 128 or chr(_b).isalnum():
        _CLASS[_b] = 1
AGAIN = 0


def index_vectors() -> np.ndarray:
    """The random vector of every bucket: a few entries of +1 or -1."""
    rng = np.random.default_rng(20240501)
    return rng.choice(np.array([-1, 0, 1], np.float32), (BUCKETS, DIMENSIONS), p=[0.1, 0.8, 0.1])


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens, and of each text the index of its first one."""
    low = tv.LOWER[data]
    kind = _CLASS[low]
    start, end = [], []
    for k in (1, 2):
        a, b = tv.runs(kind == k, off)
        start.append(a)
        end.append(b)
    start, end = np.concatenate(start), np.concatenate(end)
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    h = tv.hashes(low, start, end)
    token = (h % U(BUCKETS - 1)).astype(np.int64) + 1
    first = np.searchsorted(start, off)
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[first[:-1][first[:-1] < len(h)]] = False
    token[same] = AGAIN
    return token, first


def neighbours(token: np.ndarray, first: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The sum of the index vectors around each token."""
    total = np.zeros((len(token), index.shape[1]), np.float32)
    own = index[token]
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for r in range(1, REACH + 1):
        if len(token) > r:
            with_next = (owner[r:] == owner[:-r])[:, None]
            total[:-r] += own[r:] * with_next
            total[r:] += own[:-r] * with_next
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, table_ = index_vectors(), np.zeros((BUCKETS, DIMENSIONS))
    for batch in batches:
        for _, _, data, off in tv.chunks(batch.column("text"), 1 << 20):
            token, first = tokens(data, off)
            around = neighbours(token, first, index)
            for d in range(DIMENSIONS):
                table_[:, d] += np.bincount(token, around[:, d], BUCKETS)
    blocks = table_.astype(np.float32).reshape(BLOCKS, -1)
    task = TaskContext.get().partitionId()
    rows = [np.arange(BLOCKS, dtype=np.int32), np.full(BLOCKS, task % 64, np.int32), np.full(BLOCKS, task, np.int32)]
    yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array([b.tobytes() for b in blocks], pa.binary())], ["block", "salt", "task", "part"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block and salt of this partition, summed in the order of tasks, so that reruns agree; holds 64
    tables at most."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for *block, part in zip(batch.column("block").to_pylist(), batch.column("salt").to_pylist(), batch.column("part")):
            block = tuple(block)
            values = np.frombuffer(part.as_buffer(), np.float32)
            if block in sums:
                sums[block] += values
            else:
                sums[block] = values.astype(np.float64)
    if sums:
        block, salt = zip(*sums)
        rows = [block, [0] * len(sums), salt]
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int32()) for x in rows), pa.array([s.astype(np.float32).tobytes() for s in sums.values()], pa.binary())], ["block", "salt", "task", "part"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vector of every bucket, of unit length, from all texts."""
    schema = "block int, salt int, task int, part binary"
    rows = docs.select("text").mapInArrow(tv.lean(_sums), schema)
    for parts, by in ((64, ["block", "salt"]), (BLOCKS, ["block"])):
        rows = rows.repartition(parts, *by).sortWithinPartitions("block", "salt", "task").mapInArrow(_added, schema)
    vectors = np.zeros((BLOCKS, BUCKETS // BLOCKS, DIMENSIONS))
    for r in rows.collect():  # BLOCKS rows
        vectors[r.block] += np.frombuffer(r.part, np.float32).reshape(-1, DIMENSIONS)
    return unit(vectors.reshape(BUCKETS, DIMENSIONS))


def unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(data: np.ndarray, off: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and deviation of the word vectors of each text."""
    token, first = tokens(data, off)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * DIMENSIONS), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        x = vectors[token]
        at, count = first[:-1][some], n[some][:, None]
        mean = np.add.reduceat(x, at, axis=0) / count
        out[some, :DIMENSIONS] = mean
        out[some, DIMENSIONS:] = np.sqrt(np.maximum(np.add.reduceat(x * x, at, axis=0) / count - mean * mean, 0))
    return out


class Network:
    """Two layers; probabilities calibrated by one temperature."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = 2 * DIMENSIONS
        self.mean, self.scale, self.temperature = np.zeros(n), np.ones(n), 1.0
        self.p = [rng.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0]
        self.constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.p[0] + self.p[1], 0)
        return h @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        if len(set(y.tolist())) < 2:
            self.constant = float((y.sum() + 1) / (len(y) + 2))
            return self
        rng = np.random.default_rng(11)
        order = rng.permutation(len(y))
        kept = order[: max(1, len(y) // 10)]
        train = order[len(kept) :] if len(y) > 20 else order
        self.mean, self.scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-4
        m, v = [0.0] * 4, [0.0] * 4
        for step in range(1, STEPS + 1):
            pick = rng.choice(train, min(256, len(train)), replace=False)
            z = (x[pick] - self.mean) / self.scale
            a = z @ self.p[0] + self.p[1]
            h = np.maximum(a, 0)
            e = (1 / (1 + np.exp(-np.clip(h @ self.p[2] + self.p[3], -30, 30))) - y[pick]) / len(pick)
            back = np.outer(e, self.p[2]) * (a > 0)
            grads = [z.T @ back + 1e-4 * self.p[0], back.sum(axis=0), h.T @ e + 1e-4 * self.p[2], e.sum()]
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        logit = self.logits(x[kept])
        grid = np.exp(np.linspace(-1.5, 2.5, 81))
        loss = [np.mean(np.logaddexp(0, np.where(y[kept] == 1, -1, 1) * logit / t)) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        return self


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    sc = docs.sparkSession.sparkContext
    vectors = sc.broadcast(word_vectors(docs))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in tv.chunks(batch.column("text"), 1 << 20):
                x = pooled(data, off, vectors.value)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "x"])

    x = durable(docs.select("doc_id", "text").mapInArrow(pool, "doc_id long, x binary"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.when(F.avg("quality") >= 0.5, 1).otherwise(0).alias("y"))
    known = least_hashes(durable(known), F.xxhash64("doc_id"), "doc_id", SAMPLE)
    sample = x.join(if_small(durable(known), 16), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.min("y").alias("y")).orderBy("doc_id").toPandas()
    features = np.frombuffer(b"".join(sample["x"]), np.float32).reshape(-1, 2 * DIMENSIONS).astype(np.float64)
    network = sc.broadcast(Network().fit(features, sample["y"].to_numpy(np.float64)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, 2 * DIMENSIONS)
            s = network.value.score(f.astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "x").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
