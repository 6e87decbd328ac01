"""Best-fit packing of documents into token sequences by a distributed grouping genetic algorithm.

Documents are tokenized and only those longer than a sequence are cut. The pieces are dealt into groups of
about GROUP pieces, a number that grows with the corpus. Each group is evolved on ISLANDS islands: an
individual is an assignment of pieces to bins; crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold a piece twice, and best-fits the pieces so displaced. After each epoch every
island sends its best individual to the next island of its group; the best one of all islands is kept.

Defined cases
    null or empty text: one piece, the end id only. Null doc_id: packed like any other.
    repeated rows: pieces of their own. Very long texts: tokenized in blocks, cut into whole sequences with the
    rest first. Ties: broken by a generator seeded by group and island, so reruns on the same rows agree.
    empty table: empty result. Extra columns: ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import durable, table

LENGTH, END_ID = 2048, 0
GROUP, ISLANDS, EPOCHS, POPULATION, CHILDREN = 4096, 4, 3, 6, 30
BLOCK = 1 << 20


class Encoder:
    """Text -> ids as little-endian unsigned 32-bit, equal to those of the tokenizer file's own library.

    The file's vocabulary is handed to tiktoken, which applies the same merges several times faster.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # byte-level vocabularies write each byte as a printable character
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
        added = {t.content: (n, t) for n, t in self.tokenizer.get_added_tokens_decoder().items()}
        ranks = {bytes(letter[c] for c in token): n for token, n in self.tokenizer.get_vocab().items() if token not in added}
        # an added token that takes the blanks around it, or only whole words, is left to the file's own library
        self.plain = not any(t.lstrip or t.rstrip or t.single_word for _, t in added.values())
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={c: n for c, (n, _) in added.items()})
        # a text may be cut before a single blank between two other characters without changing a pre-token
        self.cut = regex.compile(r"\S (?=\S)")

    def block(self, text: str) -> bytes:
        if self.plain:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except BaseException as e:  # its pattern engine gives up on endless white space, in a panic that is no Exception
                if type(e).__name__ != "PanicException" and not isinstance(e, ValueError):
                    raise
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if len(text) <= BLOCK:
            return self.block(text)
        out, at = [], 0
        while at < len(text):
            m = self.cut.search(text, at + BLOCK)
            stop = m.start() + 1 if m else len(text)
            out.append(self.block(text[at:stop]))
            at = stop
        return b"".join(out)


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.PATTERN


def pieces(docs: DataFrame, path: str | None = None, pattern: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        standard = default_tokenizer() if path is None or pattern is None else (path, pattern)
        encode = Encoder(path or standard[0], pattern or standard[1])
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = batch.column("text")
            for row in range(batch.num_rows):
                ids = encode(texts[row].as_py() or "") + end
                n = len(ids) // 4
                first = n % length or length
                edges = [0, *range(first, n + 1, length)] if n > length else [0, n]
                rows += [(row, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            which, *rest = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(which)), pa.array(rest[0].astype(np.int32)), *map(pa.array, rest[1:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---- one island ------------------------------------------------------------------------------------


class Bins:
    """Open bins by what is free in them, for best fit in a few steps per piece."""

    def __init__(self, free: np.ndarray, length: int):
        self.length, self.n = length, len(free)
        self.by, self.mask = [[] for _ in range(length + 1)], 0
        for k, f in enumerate(free.tolist()):
            self.by[f].append(k)
            self.mask |= 1 << f

    def place(self, items: np.ndarray, size: np.ndarray, bin_of: np.ndarray) -> None:
        by, mask, n, length = self.by, self.mask, self.n, self.length
        for item, s in zip(items.tolist(), size[items].tolist()):
            fits = mask >> s
            if fits:
                free = s + (fits & -fits).bit_length() - 1
                k = by[free].pop()
                if not by[free]:
                    mask ^= 1 << free
            else:
                free, k, n = length, n, n + 1
            bin_of[item] = k
            left = free - s
            by[left].append(k)
            mask |= 1 << left
        self.mask, self.n = mask, n


def best_fit(order: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    bin_of = np.zeros(len(size), np.int32)
    Bins(np.zeros(0, np.int64), length).place(order, size, bin_of)
    return bin_of


def fitness(bin_of: np.ndarray, size: np.ndarray, length: int) -> float:
    """Fewer bins first; of as many bins, the ones filled less evenly, which leave more room in one place."""
    fill = np.bincount(bin_of, size) / length
    fill = fill[fill > 0]
    return float((fill * fill).mean() - len(fill))


def crossover(a: np.ndarray, b: np.ndarray, size: np.ndarray, length: int, rng: np.random.Generator) -> np.ndarray:
    """A child of b with whole well-filled bins of a."""
    fill = np.bincount(a, size)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, int(len(good) * rng.uniform(0.1, 0.6))), replace=False)] = True
    injected = chosen[a]
    hit = np.zeros(int(b.max()) + 1, bool)
    hit[b[injected]] = True
    # the emptiest of the other bins go too, so that their pieces look for a better place
    rest = np.bincount(b, size)
    hit |= rest <= np.quantile(rest, rng.uniform(0.02, 0.1))
    displaced = np.flatnonzero(hit[b] & ~injected)
    label = np.where(injected, a.astype(np.int64) + len(hit), b)
    stays = injected | ~hit[b]
    child = np.zeros(len(size), np.int32)
    _, child[stays] = np.unique(label[stays], return_inverse=True)
    bins = Bins(length - np.bincount(child[stays], size[stays]).astype(np.int64), length)
    key = size[displaced] * rng.uniform(0.97, 1.03, len(displaced))
    bins.place(displaced[np.argsort(-key, kind="stable")], size, child)
    return child


def evolve(size: np.ndarray, length: int, people: list[np.ndarray], seed: int, children: int) -> list[np.ndarray]:
    """The population after so many children, best first."""
    rng = np.random.default_rng(seed)
    least = -(-int(size.sum()) // length)
    if not people:
        people = [best_fit(np.argsort(-size, kind="stable"), size, length)]
    while len(people) < POPULATION and len(size) > 1:
        people.append(best_fit(np.argsort(-size * rng.uniform(0.9, 1.1, len(size)), kind="stable"), size, length))
    ranked = sorted(((fitness(p, size, length), k, p) for k, p in enumerate(people)), key=lambda x: (-x[0], x[1]))
    for k in range(children if len(size) > 1 else 0):
        if len(np.unique(ranked[0][2])) <= least:
            break
        i, j = rng.choice(len(ranked), 2, replace=len(ranked) < 2)
        child = crossover(ranked[i][2], ranked[j][2], size, length, rng)
        ranked.append((fitness(child, size, length), 1000 + k, child))
        ranked = sorted(ranked, key=lambda x: (-x[0], x[1]))[:POPULATION]
    return [p for _, _, p in ranked]


# ---- islands on Spark ------------------------------------------------------------------------------


def _epoch(length: int, children: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples():
                size = np.frombuffer(r.sizes, "<i4").astype(np.int64)
                people = [np.frombuffer(p, "<i4") for p in ([] if r.people is None else r.people)]
                people = evolve(size, length, people, hash((r.grp, r.island, r.epoch)) & 0x7FFFFFFF, children)
                out.append((r.grp, r.island, r.epoch + 1, r.sizes, [p.astype("<i4").tobytes() for p in people], fitness(people[0], size, length)))
            yield pd.DataFrame(out, columns=["grp", "island", "epoch", "sizes", "people", "score"])

    return run


def _laid(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for r in frame.itertuples():
            size, bin_of = np.frombuffer(r.sizes, "<i4").astype(np.int64), np.frombuffer(r.best, "<i4")
            order = np.argsort(bin_of, kind="stable")
            before = np.cumsum(size[order]) - size[order]
            head = np.searchsorted(bin_of[order], bin_of[order])
            rid = np.asarray(r.rids, np.int64)
            yield pd.DataFrame({"rid": rid[order], "sequence_id": r.grp * (1 << 24) + bin_of[order].astype(np.int64), "offset": before - before[head]})


def place(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """rid, sequence_id, offset for items (rid, length), which must be cut from their lineage."""
    groups = max(1, -(-items.count() // GROUP))
    spark = items.sparkSession
    dealt = items.select("rid", "length", F.pmod(F.xxhash64("rid"), F.lit(groups)).alias("grp"))
    # a list per group: its size is bounded by the deal
    lists = dealt.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("rid", "length"))).alias("x"))
    pack = F.udf(lambda x: np.array(x, "<i4").tobytes(), "binary")
    lists = durable(lists.select("grp", F.col("x.rid").alias("rids"), pack("x.length").alias("sizes")))
    schema = "grp long, island int, epoch int, sizes binary, people array<binary>, score double"
    tasks = min(groups * ISLANDS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups * ISLANDS // 8))
    state = lists.select("grp", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.lit(0).alias("epoch"), "sizes", F.lit(None).cast("array<binary>").alias("people"))
    for epoch in range(EPOCHS):
        state = durable(state.repartition(tasks, "grp", "island").mapInPandas(_epoch(length, CHILDREN), schema))
        if epoch < EPOCHS - 1:
            guest = state.select("grp", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("people", 1, 1).alias("guest"))
            state = state.join(guest, ["grp", "island"]).select("grp", "island", "epoch", "sizes", F.slice(F.concat("guest", "people"), 1, POPULATION).alias("people"))
    best = state.groupBy("grp").agg(F.max_by(F.struct("sizes", F.element_at("people", 1).alias("best")), F.struct("score", "island")).alias("x"))
    return best.join(lists.select("grp", "rids"), "grp").select("grp", "x.sizes", "x.best", "rids").mapInPandas(_laid, "rid long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, pattern: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = durable(pieces(docs, path, pattern, length).withColumn("rid", F.monotonically_increasing_id()))
    placed = place(cut.select("rid", "length"), length)
    return cut.join(placed, "rid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
