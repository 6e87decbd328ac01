"""Connected components: each task contracts its own links, then alternating star contractions, all in DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import textvec as tv
from lectern.llm.common import durable

#: Links that a task holds and contracts at once.
TASK_LINKS = 1 << 20


def smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vertices of links (a, b), each once, and the smallest vertex that each one reaches."""
    v, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(v))
    while len(x):
        # larger roots go below smaller ones, then every vertex goes to its root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    return v, v[root]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, u): each vertex of the links (a, b) that the task holds and its root; a root's own row is (v, v)."""
    held, size = [], 0

    def told():
        a, b = (np.concatenate(c) for c in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in smallest(a, b)], ["v", "u"])

    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        for k in range(0, len(a), TASK_LINKS):
            if size + len(a[k : k + TASK_LINKS]) > TASK_LINKS:
                yield told()
                held, size = [], 0
            held.append((a[k : k + TASK_LINKS], b[k : k + TASK_LINKS]))
            size += len(held[-1][0])
    if size:
        yield told()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """v, root for every vertex of edges (a, b: long; cheap to count, so checkpointed); root is the smallest vertex of its component.

    Links are dealt to one task for each TASK_LINKS of them, and a task gives one link for each vertex it holds. With
    several tasks, rounds follow: each one links every vertex's larger neighbours to its smallest one, then every
    vertex's smaller neighbours to the smallest of them; both use sums by key that combine before the shuffle, so a
    vertex with a third of all links is no hot task. The rounds end when the links stop changing. What a single task
    held is contracted already.
    """
    links = edges.where("a <> b").select("a", "b")
    tasks = -(-links.count() // TASK_LINKS)
    now = links.coalesce(max(1, tasks)).mapInArrow(tv.lean(_contracted), "v long, u long")
    if tasks <= 1:
        return now.select("v", F.col("u").alias("root"))
    now = durable(now.where("v <> u").distinct())
    before = None
    for _ in range(rounds):
        both = now.select("v", "u").union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("x")).select("x.*")
        now = durable(small.where("v <> u").distinct())
        # the xor of hashes of all links tells whether they changed
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("h")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select("v", F.col("u").alias("root")).union(now.select(F.col("u").alias("v"), F.col("u").alias("root")).distinct())
