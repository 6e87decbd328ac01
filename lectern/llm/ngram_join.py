"""N-gram Jaccard self-join with PartEnum signatures, and the components of its links.

A document's set holds the hashes of its distinct five-word shingles. Sets are put in size bands such that
linked sets lie in one band or in neighbouring ones; a set goes into its own band and, if a partner can lie there,
into the next larger one. For each band the hash domain is dealt into parts and each part into CELLS cells. Two sets
that link differ in at most k elements. In a part with fewer than CELLS - CHOSEN + 1 differing elements some CHOSEN
cells have none, so a signature for each choice of CHOSEN cells of a part, (band, part, choice, hash of the set's share
of those cells), is common to both. Choices of empty cells are never sent, as unrelated sets would meet there; a set with
o cells occupied in a part needs min(CELLS - CHOSEN + 1, o) differences there before no choice agrees. The sum of
that over its parts is the set's strength, and if it exceeds k, no link of the set is lost. Bands up to SINGLES elements
take every element as a signature of its own, so that holds by construction. In larger ones the number of parts
leaves a margin; a set whose strength falls short nevertheless is told by name and sought by its elements in all
documents (see sought), so the join is exact.

Equal signatures meet in one exchange of packed arrays. Copies of a set are one vertex from the start. A group
of up to SMALL vertices gives all its pairs; a larger one gives its pairs with its smallest vertex only, and
its members are kept. A member leaves aside as many signatures as it can spare, the largest groups first (see
_unsettled). When the pairs are verified and contracted, groups whose members are in one component need nothing more.
The others, merged where they have most members in common (see _merged), are compared inside tasks, block against block of
at most BLOCK members, and only pairs that may link leave a task; where these are many, the best partner of each member outside the largest component comes first, round by
round, and the rest only if contraction leaves them apart. So near copies by the thousand cost pairs in proportion to their number, and no link is lost.

Before sets are sent for a pair, the counts of their elements in hash buckets, as many as they have elements, bound
what they can share; that drops pairs which only share a passage, never one that links. A pair's sets meet in a cell of
its smaller vertex, a vertex of many pairs having several cells.

Defined cases
    null, empty or wordless text: n_shingles 0, linked with nothing, component_id its own doc_id.
    one to four words: the whole sequence is the only element.
    repeated rows and exact copies: one vertex; their component_id is the smallest doc_id of all.
    null doc_id: ignored as a name; its component_id is that of its set, null if no row of it has an id.
    very long texts: whole. Empty table: empty result. Extra columns: ignored by join(), carried by one_of_each().
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm import textvec as tv
from lectern.llm.common import WORD, durable, fresh, gathered, if_small, table
from lectern.llm.components import components

WORDS, PERCENT = 5, 75
SINGLES, SMALL, BLOCK = 64, 8, 2048
#: Second-level cells of a part, and how many of them a signature covers.
CELLS, CHOSEN = 3, 2
KILL = CELLS - CHOSEN + 1
#: The number of parts makes a set's strength exceed k by so many standard deviations.
MARGIN = 5
FLUSH = 1 << 20
#: Added to a pair's count for each small group that holds it; the other pairs, with the smallest member of a large
#: group, only save work later and are tried if they share LIKELY groups or more.
MUST, LIKELY = 1 << 32, 4
#: The largest count that a sketch tells.
MANY = 15
#: Buckets of a sketch that are one bucket of the rough sketch, by which pairs are tried first.
ROUGH = 4
#: Pairs of one vertex that meet in one cell; pairs that leave a block at once, besides one for every fourth member.
SHARD, FEW = 512, 64
#: Element hashes of sought sets that are sent to all tasks at once.
PROBES = 1 << 20
U = tv.U


def differing(size: np.ndarray | int, partner: np.ndarray | int) -> np.ndarray | int:
    """The most elements in which sets of these sizes that link can differ."""
    return (size + partner) * (100 - PERCENT) // (100 + PERCENT)


def _strength(size: float, parts: int) -> tuple[float, float]:
    """Mean and deviation of the strength of a set of so many elements, dealt at random to the cells of so many parts."""

    def moments(size: float) -> tuple[float, float]:
        full = 1 - np.exp(-size / (CELLS * parts))
        p = [comb(CELLS, o) * full**o * (1 - full) ** (CELLS - o) for o in range(CELLS + 1)]
        mean = sum(min(KILL, o) * q for o, q in enumerate(p))
        return parts * mean, parts * (sum(min(KILL, o) ** 2 * q for o, q in enumerate(p)) - mean * mean)

    mean, spread = moments(size)
    # the number of elements is fixed, which takes its share from the variance of independent cells
    slope = (moments(size * 1.01)[0] - mean) / (size * 0.01)
    return mean, max(0.0, spread - size * slope * slope) ** 0.5


def _parts(low: int, high: int) -> int:
    """Parts of a band such that sets of all sizes that are sent there keep the margin; 0 if no number does."""
    sizes = np.unique(np.geomspace(max(1, low * PERCENT // 100), high, 12).astype(int)).tolist()
    need = [(s, differing(s, min(s * 100 // PERCENT, high))) for s in sizes]
    parts = max(1, high // 16)
    while parts < high:
        told = [(*_strength(s, parts), k) for s, k in need]
        if all(mean - MARGIN * deviation > k + 1 for mean, deviation, k in told):
            return parts
        parts += max(1, parts // 40)
    return 0


@lru_cache
def bands(percent: int = PERCENT, most: int = 1 << 31) -> tuple[np.ndarray, np.ndarray]:
    """Smallest size of each band, and number of its parts, 0 if each element is a signature."""
    low = [1]
    while low[-1] < most:
        low.append(max(low[-1] + 1, low[-1] * 10_000 // percent**2 + 1))
    parts = [0 if high <= SINGLES else _parts(a, high) for a, high in zip(low, (x - 1 for x in low[1:]))]
    return np.array(low, np.int64), np.array([*parts, 0], np.int64)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin."""
    low = tv.LOWER[data]
    start, end, first = tv.words(low, off)
    seq = tv.Sequence(tv.hashes(low, start, end))
    count = np.diff(first)
    owner, at = tv.ragged(np.where(count >= WORDS, count - WORDS + 1, np.minimum(count, 1)))
    a = first[:-1][owner] + at
    h = seq.of(a, np.minimum(a + WORDS, first[1:][owner]))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(off)))


def set_keys(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for the empty one."""
    total = np.concatenate([np.zeros(1, U), np.cumsum(tv.mix(h ^ U(0x51ED270B)))])
    n = np.diff(edge).astype(U)
    key = tv.mix((total[edge[1:]] - total[edge[:-1]]) + n * U(0x9E3779B97F4A7C15)) >> U(1)
    return np.where(n == 0, U(0), key).astype(np.int64)


def _sent(edge: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For role 0 (own band) or 1 (next larger one): whether each set is sent, its band, and its largest partner."""
    low, _ = bands()
    size = np.diff(edge)
    band = np.searchsorted(low, size, "right") - 1 + own
    most = size * 100 // PERCENT
    if own:
        return (size > 0) & (most >= low[band]), band, most
    return size > 0, band, np.minimum(most, low[band + 1] - 1)


def _shares(h: np.ndarray, edge: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which set each part is of, and hash and occupation of its cells; n: parts of each set. Elements are sorted by
    hash and cells are stretches of the hash domain, so a cell's elements stand together."""
    owner = np.repeat(np.arange(len(n)), np.where(n > 0, np.diff(edge), 0))
    mine = h[np.repeat(n > 0, np.diff(edge))]
    cells = n * CELLS
    slot = (np.cumsum(cells) - cells)[owner] + (((mine >> U(32)) * cells[owner].astype(U)) >> U(32)).astype(np.int64)
    total, full = np.zeros(int(cells.sum()), U), np.zeros(int(cells.sum()), bool)
    if len(slot):
        at = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        total[slot[at]] = np.add.reduceat(tv.mix(mine ^ U(0x2545F4914F6CDD1D)), at)
        full[slot[at]] = True
    return np.repeat(np.arange(len(n)), n), total.reshape(-1, CELLS), full.reshape(-1, CELLS)


def _signatures(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, signature, role) of all sets; role: 0 in the set's own band, 1 in the next larger one."""
    parts = bands()[1]
    size, out = np.diff(edge), []
    for own in (0, 1):
        go, band, _ = _sent(edge, own)
        n = np.where(go, parts[band], 0)
        tag = tv.mix(band.astype(U) + U(977))
        single = go & (n == 0)
        who = np.repeat(np.flatnonzero(single), size[single])
        out.append((who, tv.mix(tv.mix(h[np.repeat(single, size)] ^ U(0x9E3779B97F4A7C15)) ^ tag[who])))
        who, total, full = _shares(h, edge, n)
        part = (np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)).astype(U)
        cell = tv.mix(total ^ tv.mix(np.arange(1, CELLS + 1, dtype=U))) * full
        for k, chosen in enumerate(combinations(range(CELLS), CHOSEN)):
            some = full[:, chosen].any(axis=1)
            name = tv.mix(part[some] * U(64) + U(k + 1)) ^ tag[who[some]]
            out.append((who[some], tv.mix(cell[some][:, chosen].sum(axis=1, dtype=U) ^ name)))
        out[-1 - comb(CELLS, CHOSEN) :] = [(w, s, np.full(len(w), own, np.int8)) for w, s in out[-1 - comb(CELLS, CHOSEN) :]]
    return tuple(np.concatenate(x) for x in zip(*out))


def spares(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each set and role, how many of its signatures it can do without: a signature less takes at most one from its
    strength, and any partner agrees with it on one of the others as long as that exceeds the elements that differ.
    Negative: links of the set may be lost."""
    parts, out = bands()[1], []
    size = np.diff(edge)
    for own in (0, 1):
        go, band, most = _sent(edge, own)
        n = np.where(go, parts[band], 0)
        who, _, full = _shares(h, edge, n)
        strength = np.where(n == 0, size, np.bincount(who, np.minimum(full.sum(axis=1), KILL), len(n)).astype(np.int64))
        out.append(np.where(go, strength - differing(size, most) - 1, 0))
    return out[0], out[1]


def sketches(h: np.ndarray, edge: np.ndarray) -> list[bytes]:
    """Counts of each set's elements by their hashes' first bits, in as many buckets as the largest power of two
    that is no larger than the set, two at least; two counts in a byte, MANY standing for that and more."""
    size = np.diff(edge)
    bits = _bits(size)
    width = np.where(size > 0, 1 << bits.astype(np.int64), 0)
    begin = np.cumsum(width) - width
    out = []
    step = np.searchsorted(np.cumsum(width), np.arange(0, int(width.sum()) + 1, 1 << 22))
    for a, b in zip(step, [*step[1:], len(size)]):
        if a == b:
            continue
        base = begin[a:b] - begin[a]
        owner = np.repeat(np.arange(b - a), size[a:b])
        mine = h[edge[a] : edge[b]]
        shift = (64 - bits[a:b]).astype(U)[owner]
        slot = np.where(shift == 64, U(0), mine >> np.minimum(shift, U(63))).astype(np.int64) + base[owner]
        count = _pairwise(np.bincount(slot, minlength=int(width[a:b].sum())))
        out += [count[x : x + w].tobytes() for x, w in zip((base // 2).tolist(), (width[a:b] // 2).tolist())]
    return out


def _bits(size: np.ndarray) -> np.ndarray:
    return np.maximum(np.frexp(np.maximum(size, 1))[1] - 1, 1)


def _pairwise(count: np.ndarray) -> np.ndarray:
    count = np.minimum(count, MANY).astype(np.uint8)
    return count[0::2] | count[1::2] << np.uint8(4)


def _counts(sketches: list[bytes]) -> np.ndarray:
    """The counts of sketches of one length, a row each."""
    both = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    return np.stack([both & np.uint8(MANY), both >> np.uint8(4)], axis=2).reshape(len(sketches), -1)


def _sender(parts: int):
    """Packs (signature, vertex, role) by part. A set that this task has sent already is not sent again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, sent = [], 0, np.zeros(0, np.int64)

        def flush():
            sig, v, role = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(v, kind="stable")  # a vertex's signatures stand together, which compresses well
            sig, v, role = sig[order], v[order], role[order]
            # 32 bits and the part's number are enough to meet by; pairs are verified
            return tv.packed({"sig": (sig >> U(32)).astype(np.uint32), "v": v, "role": role}, (sig % U(parts)).astype(np.int32), parts)

        for batch in batches:
            for _, _, data, off in tv.chunks(batch.column("text")):
                h, edge = shingle_sets(data, off)
                v = set_keys(h, edge)
                _, once = np.unique(v, return_index=True)
                once = once[(v[once] != 0) & ~np.isin(v[once], sent)]
                sent = np.concatenate([sent, v[once]])[-(1 << 20) :]
                keep = np.zeros(len(v), bool)
                keep[once] = True
                h = h[np.repeat(keep, np.diff(edge))]
                edge, v = np.concatenate([[0], np.cumsum(np.diff(edge)[keep])]), v[keep]
                who, sig, role = _signatures(h, edge)
                held.append((sig, v[who], role))
                size += len(sig)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _groups(columns: tv.Columns) -> Iterator[pa.RecordBatch]:
    """Pairs (gid null) of small groups, n counting MUST for each, and with the smallest vertex of large ones; members of large groups:
    gid, a: vertex, b: twice the number of members, plus the role, n: so many parts have these members."""
    sig, v, role = columns["sig"], columns["v"], columns["role"]
    order = np.lexsort((v, sig))
    sig, v, role = sig[order], v[order], role[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (v[1:] != v[:-1])
    sig, v, role = sig[new], v[new], role[new]
    head = np.ones(len(sig), bool)
    head[1:] = sig[1:] != sig[:-1]
    start = np.flatnonzero(head)
    count = np.diff(np.append(start, len(sig)))
    many = count > 1
    start, count = start[many], count[many]
    a, b, must = [], [], []
    owner, at = tv.ragged(count)
    star = (at > 0) & (count[owner] > SMALL)
    a.append(v[start[owner[star]]])
    b.append(v[start[owner[star]] + at[star]])
    must.append(np.zeros(int(star.sum()), np.int64))
    for step in range(1, SMALL):  # all pairs of small groups: (i, i + step)
        ok = (count[owner] <= SMALL) & (at + step < count[owner])
        a.append(v[start[owner[ok]] + at[ok]])
        b.append(v[start[owner[ok]] + at[ok] + step])
        must.append(np.full(int(ok.sum()), MUST))
    a, b, must = np.concatenate(a), np.concatenate(b), np.concatenate(must)
    order = np.lexsort((b, a))
    a, b, must = a[order], b[order], must[order]
    head = np.ones(len(a), bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(head)
    n = np.add.reduceat(must + 1, first) if len(first) else must
    pairs = {"a": a[first], "b": b[first]}
    names = ["gid", "a", "b", "n"]
    for i in range(0, len(first), 1 << 18):
        some = [pa.array(c[i : i + (1 << 18)]) for c in (pairs["a"], pairs["b"], n)]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some[0]), pa.int64()), *some], names)
    # large groups are named by their members, so that groups of the same members are one
    big = np.flatnonzero(count > SMALL)
    if len(big):
        total = np.concatenate([np.zeros(1, U), np.cumsum(tv.mix(v.view(U) ^ role.astype(U)))])
        name = tv.mix(total[start[big] + count[big]] - total[start[big]] + count[big].astype(U))
        name, once, times = np.unique(name, return_index=True, return_counts=True)
        big = big[once]
        owner, at = tv.ragged(count[big])
        size = 2 * count[big][owner]
        where, name, times = start[big][owner] + at, name[owner].view(np.int64), times[owner].astype(np.int64)
        for i in range(0, len(where), 1 << 18):
            w = where[i : i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(name[i : i + (1 << 18)]), pa.array(v[w]), pa.array(size[i : i + (1 << 18)] + role[w]), pa.array(times[i : i + (1 << 18)])], names)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        more = [c for c in batch.schema.names if c not in ("doc_id", "text")]
        for i, j, data, off in tv.chunks(batch.column("text")):
            h, edge = shingle_sets(data, off)
            columns = [batch.column("doc_id")[i:j], pa.array(np.diff(edge)), pa.array(set_keys(h, edge)), pa.array(sketches(h, edge), pa.binary()), *map(pa.array, spares(h, edge))]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c)[i:j] for c in more)], ["doc_id", "n_shingles", "v", "sketch", "spare0", "spare1", *more])


def _folded(rows: np.ndarray, width: int) -> np.ndarray:
    """Sketches in fewer buckets; a count that may be more than it tells makes the bucket 65535."""
    if rows.shape[1] == width:
        return np.where(rows == MANY, np.uint16(65535), rows)
    parts = rows.reshape(len(rows), width, -1)
    return np.where((parts == MANY).any(axis=2), np.uint16(65535), parts.sum(axis=2, dtype=np.uint16))


def _shared(x: np.ndarray, y: np.ndarray, s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The most elements that sets of sizes s, t with folded sketches x, y can share."""
    return np.minimum(np.minimum(x, y).sum(axis=1, dtype=np.int64), np.minimum(s, t))


def _links(both: np.ndarray, s: np.ndarray, t: np.ndarray) -> np.ndarray:
    return 100 * both >= PERCENT * (s + t - both)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column("ka"), batch.column("kb")
        s, t = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        keep = np.zeros(batch.num_rows, bool)
        width = np.stack([np.diff(np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]) for c in (x, y)], axis=1)
        for w in np.unique(width, axis=0):
            at = np.flatnonzero((width == w).all(axis=1))
            for k in range(0, len(at), max(1, (1 << 21) // int(w.max()))):
                some = at[k : k + max(1, (1 << 21) // int(w.max()))]
                rows = [_folded(_counts(c.take(pa.array(some)).to_pylist()), 2 * int(w.min())) for c in (x, y)]
                keep[some] = _links(_shared(*rows, s[some], t[some]), s[some], t[some])
        names = ["a", "b", "n", "na", "nb"]
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in names], names)


def _rough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for s in batch.column("sketch"):
            row = _counts([s.as_py()])
            out.append(_pairwise(_folded(row, max(2, row.shape[1] // ROUGH))[0]).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array(out, pa.binary())], ["v", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent = np.zeros(0, np.int64)
    for batch in batches:
        for _, _, data, off in tv.chunks(batch.column("text")):
            h, edge = shingle_sets(data, off)
            v = set_keys(h, edge)
            _, once = np.unique(v, return_index=True)
            once = once[~np.isin(v[once], sent)]
            sent = np.concatenate([sent, v[once]])[-(1 << 20) :]
            sets = [h[edge[k] : edge[k + 1]].tobytes() for k in once]
            yield pa.RecordBatch.from_arrays([pa.array(v[once]), pa.array(sets, pa.binary())], ["v", "set"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) that link; a cell's rows stand together, its vertex's own set first."""
    now, mine = None, None
    for batch in batches:
        out = [], []
        cell, shard, first, v, sets = (batch.column(c) for c in ("cell", "shard", "rest", "v", "set"))
        cell, shard, rest, v = cell.to_numpy(), shard.to_numpy(), first.to_numpy(), v.to_numpy()
        for i in range(batch.num_rows):
            s = np.frombuffer(sets[i].as_buffer(), U)
            if not rest[i]:
                now, mine = (cell[i], shard[i]), s.copy()
                continue
            assert now == (cell[i], shard[i])
            small, large = (s, mine) if len(s) <= len(mine) else (mine, s)
            if 100 * len(small) >= PERCENT * len(large):
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if _links(both, len(small), len(large)):
                    out[0].append(cell[i])
                    out[1].append(v[i])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])


def likely(pairs: DataFrame, described: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (a, b, n) that may link, by their sets' sizes, their rough sketches and then their sketches. Most pairs
    go by the rough ones, so few whole sketches are sent."""
    size = lambda c: named.select(F.col("v").alias(c), F.col("n_shingles").alias(f"n{c}"))
    sized = pairs.join(size("a"), "a").join(size("b"), "b").where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    sized = gathered(durable(sized))
    known = sketches_of(_ends(sized), described, named)
    some = _tried(sized, durable(known.mapInArrow(tv.lean(_rough), "v long, sketch binary")))
    return _tried(gathered(durable(some)), known).select("a", "b", "n")


def _tried(pairs: DataFrame, known: DataFrame) -> DataFrame:
    side = lambda c: known.select(F.col("v").alias(c), F.col("sketch").alias(f"k{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(tv.lean(_likely), "a long, b long, n long, na long, nb long")


def sketches_of(vertices: DataFrame, described: DataFrame, named: DataFrame) -> DataFrame:
    """v, sketch of these vertices, each once: of the rows that have a vertex's set one is read."""
    rows = gathered(durable(named.select("v", "row").join(vertices, "v", "left_semi")))
    return durable(described.select("v", "row", "sketch").join(if_small(rows, 16), ["v", "row"], "left_semi").select("v", "sketch"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v"))).distinct()


def verified(pairs: DataFrame, docs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link. The sets are made again from one text each and sent to the pairs' cells."""
    pairs = pairs.select("a", "b")
    of = pairs.groupBy("a").agg(F.ceil(F.count("*") / SHARD).alias("shards"))
    shard = F.pmod(F.xxhash64("b"), F.col("shards"))
    rest = pairs.join(of, "a").select(F.col("b").alias("v"), F.col("a").alias("cell"), shard.alias("shard"), F.lit(1).alias("rest"))
    first = of.select(F.col("a").alias("v"), F.col("a").alias("cell"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.lit(0).alias("rest"))
    cells = gathered(durable(rest.union(first)))
    texts = gathered(durable(named.join(cells, "v", "left_semi").select(F.col("own").alias("__own"), F.col("own_id").alias("__id"))))
    one = (F.xxhash64("text") == F.col("__own")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    some = docs.select("doc_id", "text").join(if_small(texts, 16), one, "left_semi").select("text")
    made = some.mapInArrow(tv.lean(_sets), "v long, set binary")
    met = made.join(if_small(cells, 32), "v").repartition("cell", "shard").sortWithinPartitions("cell", "shard", "rest")
    return met.select("cell", "shard", "rest", "v", "set").mapInArrow(tv.lean(_verify), "a long, b long")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not known to be connected."""
    ra, rb = roots.select(F.col("v").alias("a"), F.col("root").alias("ra")), roots.select(F.col("v").alias("b"), F.col("root").alias("rb"))
    told = pairs.join(ra, "a", "left").join(rb, "b", "left")
    return told.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select(*pairs.columns)


def _unsettled(met: DataFrame, spare: DataFrame) -> DataFrame:
    """gid, v: the memberships of large groups that links may still hide in; spare: v, spare0, spare1.

    A vertex agrees with any partner on more parts than it can spare. So it may leave as many parts aside as it can
    spare; if all leave their largest groups aside, in one order for all, the smallest group that partners share
    is left to both of them. A vertex with enough parts in small groups leaves all its large ones aside.
    """
    rows = met.where("gid IS NOT NULL").select("gid", F.col("a").alias("v"), (F.col("b") % 2).alias("role"), F.floor(F.col("b") / 2).alias("size"), "n")
    # dealt by vertex once for all that follows; the same members may be a group in several parts of the exchange
    rows = rows.repartition("v").groupBy("gid", "v", "role").agg(F.max("size").alias("size"), F.sum("n").alias("n"))
    order = W.partitionBy("v", "role").orderBy(F.desc("size"), "gid").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("n").over(order)).join(spare.select("v", "spare0", "spare1"), "v")
    return rows.where("upto > CASE WHEN role = 0 THEN spare0 ELSE spare1 END").select("gid", "v").distinct()


def _best(a: np.ndarray, b: np.ndarray, worth: np.ndarray, v: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, ...]:
    """(member, partner, worth): the best partner of each member that is not in the block's largest component."""
    roots, number = np.unique(root, return_counts=True)
    order = np.argsort(v)
    of = lambda x: root[order[np.searchsorted(v[order], x)]]
    ends = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([worth, worth])
    ends = [c[of(ends[0]) != roots[np.argmax(number)]] for c in ends]
    order = np.lexsort((ends[1], -ends[2], ends[0]))
    ends = [c[order] for c in ends]
    first = np.concatenate([[True], ends[0][1:] != ends[0][:-1]])[: len(order)]
    return tuple(c[first] for c in ends)


def _compared(whole: bool):
    """The pairs (a, b) of each cell that may link and are apart. A cell is one block of a group against itself or
    another; its members stand together. Unless `whole`, a cell of many such pairs gives one for each member only, with
    its worth, and says so by a row with its group and no pair. A pair that several cells of this task hold leaves it
    about once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        done = np.zeros(1 << 20, U)  # the last pair of each slot

        def told(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], ["gid", "a", "b", "worth"])

        def pairs():
            v, root, n, side = (np.concatenate([c[k] for c in held]) for k in range(4))
            sketch = [s for c in held for s in c[4]]
            bits = _bits(n)
            rows = {int(w): np.flatnonzero(bits == w) for w in np.unique(bits)}
            table = {w: _counts([sketch[k] for k in at]) for w, at in rows.items()}
            found = []
            for w in rows:
                for u in (w, w + 1):
                    if u not in rows:
                        continue
                    p, q = rows[w], rows[u]
                    x, y = _folded(table[w], 1 << w), _folded(table[u], 1 << w)
                    tile = 64
                    for i in range(0, len(p), tile):
                        a, b = np.meshgrid(np.arange(i, min(i + tile, len(p))), np.arange(len(q)), indexing="ij")
                        c, d = p[a], q[b]
                        ok = (v[c] < v[d]) if u == w else (v[c] != v[d])
                        ok &= (root[c] != root[d]) & ((side[c] != side[d]) | (side[c] == 2))
                        ok &= 100 * np.minimum(n[c], n[d]) >= PERCENT * np.maximum(n[c], n[d])
                        a, b = a[ok], b[ok]
                        for k in range(0, len(a), max(1, (1 << 21) >> w)):
                            e, f = a[k : k + max(1, (1 << 21) >> w)], b[k : k + max(1, (1 << 21) >> w)]
                            both = _shared(x[e], y[f], n[p[e]], n[q[f]])
                            keep = _links(both, n[p[e]], n[q[f]])
                            if keep.any():
                                c, d = v[p[e[keep]]], v[q[f[keep]]]
                                found.append((np.minimum(c, d), np.maximum(c, d), both[keep] / (n[p[e]] + n[q[f]])[keep]))
            if not found:
                return
            a, b, worth = (np.concatenate(c) for c in zip(*found))
            few = whole or len(a) <= FEW + len(v) // 4
            if not few:
                yield told([now[0]], [None], [None], [None])
                a, b, worth = _best(a, b, worth, v, root)
            key = tv.mix(a.view(U)) + b.view(U)
            slot = (key >> U(44)).astype(np.int64)
            new = done[slot] != key
            a, b, worth = a[new], b[new], worth[new]
            done[slot[new]] = key[new]
            for k in range(0, len(a), 1 << 16):
                n = len(a[k : k + (1 << 16)])
                yield told([None] * n, a[k : k + n], b[k : k + n], [None] * n if few else worth[k : k + n])

        for batch in batches:
            cell = np.stack([batch.column(c).to_numpy() for c in ("gid", "lo", "hi")], axis=1)
            cut = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            columns = [batch.column(c).to_numpy() for c in ("v", "root", "n_shingles", "side")] + [batch.column("sketch").to_pylist()]
            for a, b in zip([0, *cut], [*cut, batch.num_rows]):
                if a == b:
                    continue
                if now is not None and tuple(cell[a]) != now:
                    yield from pairs()
                    held = []
                now = tuple(cell[a])
                held.append([c[a:b] for c in columns])
        if held:
            yield from pairs()

    return run


def _torn(told: DataFrame) -> DataFrame:
    """gid, most: its most frequent root, n: members, of each group of told (gid, v, root) that has several roots."""
    share = told.groupBy("gid", "root").agg(F.count("*").alias("n"))
    most = F.max_by("root", F.struct("n", -F.col("root"))).alias("most")
    return share.groupBy("gid").agg(most, F.sum("n").alias("n"), F.max("n").alias("major"), F.count("*").alias("roots")).where("roots > 1").drop("roots")


def _merged(told: DataFrame) -> DataFrame:
    """gid, v, root of told's groups (gid, v, root) that have several roots, merged where that saves work.

    A cluster of near copies meets in a group for each of many signatures, nearly the same members each time. Groups
    with the same most frequent root become one of all their members, named by that root, unless it has more pairs
    than they have together. A merged group has all pairs of its groups.
    """
    torn = gathered(durable(_torn(told)))
    rows = gathered(durable(told.join(torn.select("gid", "most"), "gid").select("gid", "most", "v", "root")))
    union = gathered(durable(rows.select("most", "v", "root").distinct()))
    alone = torn.groupBy("most").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    saved = union.groupBy("most").agg(F.count("*").alias("n")).join(alone, "most").where("n * n <= pairs").select("most")
    saved = gathered(durable(saved))
    merged = union.join(saved, "most", "left_semi").select(F.col("most").alias("gid"), "v", "root")
    return merged.union(rows.join(saved, "most", "left_anti").select("gid", "v", "root"))


def _hidden(told: DataFrame, known: DataFrame, whole: bool) -> DataFrame:
    """Pairs (a, b) that may link within the groups of told (gid, v, root), or gid of a group that may hold more of
    them; known: v, n_shingles, sketch. Groups over BLOCK members are dealt into blocks, those of the most frequent root
    apart from the others. Each two blocks meet in a task of their own, so no task holds more than two blocks; two blocks of
    the most frequent root have nothing to meet for, so its members are sent as often as there are blocks of others."""
    size = _torn(told)
    large = F.col("n") > BLOCK
    most = F.when(large, F.ceil(F.col("major") / BLOCK)).otherwise(0).cast("long").alias("first")
    rest = F.when(large, F.ceil((F.col("n") - F.col("major")) / BLOCK)).otherwise(1).cast("long").alias("rest")
    dealt = told.join(size.select("gid", "most", most, rest), "gid").withColumn("in_most", (F.col("root") == F.col("most")) & (F.col("first") > 0))
    mine = F.when(F.col("in_most"), F.pmod(F.xxhash64("v"), F.col("first"))).otherwise(F.col("first") + F.pmod(F.xxhash64("v"), F.col("rest")))
    begin = F.when(F.col("in_most"), F.col("first")).otherwise(0).cast("long")
    dealt = dealt.withColumn("own", mine).withColumn("other", F.explode(F.sequence(begin, F.col("first") + F.col("rest") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    cells = dealt.select("gid", "v", "root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), side.cast("long").alias("side"))
    # merged by v, so that equal sketches follow each other, which compresses well
    cells = cells.join(known.hint("merge"), "v").repartition("gid", "lo", "hi").sortWithinPartitions("gid", "lo", "hi")
    return cells.select("gid", "lo", "hi", "v", "root", "n_shingles", "side", "sketch").mapInArrow(tv.lean(_compared(whole)), "gid long, a long, b long, worth double")


def sought(docs: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs (a, b) of the sets whose signatures may lose a link, with every set that has one of their elements.

    A partner lacks at most a quarter of a set's elements, so it has one of any quarter of them and one more. These go
    to all tasks, PROBES at most at once, and every document is read for them.
    """
    unsure = durable(named.where("spare0 < 0 OR spare1 < 0").select("v", "own", "n_shingles"))
    total = unsure.agg(F.sum(F.floor(F.col("n_shingles") * (100 - PERCENT) / 100) + 1)).first()[0] or 0
    pairs, spark = [], docs.sparkSession
    times = -(-int(total) // PROBES)

    def hits(of: list, has: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for v, h, edge in _elements(batches):
                at = np.searchsorted(has, h)
                owner = np.repeat(v, np.diff(edge))[(at < len(has)) & (has[np.minimum(at, len(has) - 1)] == h)]
                at = at[(at < len(has)) & (has[np.minimum(at, len(has) - 1)] == h)]
                rows = [(x, y) for x, k in zip(owner.tolist(), at.tolist()) for y in of[k] if x != y]
                a, b = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 2
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        return run

    for k in range(times):
        mine = unsure.where(F.pmod(F.xxhash64("v", F.lit(3)), F.lit(times)) == k)
        some = docs.select("text").join(mine.select(F.col("own").alias("__own")), F.xxhash64("text") == F.col("__own"), "left_semi")
        probes: dict[int, list[int]] = {}
        for r in some.mapInArrow(tv.lean(_sets), "v long, set binary").join(mine.select("v"), "v", "left_semi").dropDuplicates(["v"]).collect():
            s = np.frombuffer(r.set, U)
            for x in s[: len(s) * (100 - PERCENT) // 100 + 1].tolist():
                probes.setdefault(x, []).append(r.v)
        has = np.array(sorted(probes), U)
        pairs.append(durable(docs.select("text").mapInArrow(hits([probes[x] for x in has.tolist()], has), "a long, b long").distinct()))
    out = spark.createDataFrame([], "a long, b long")
    for p in pairs:
        out = out.union(p)
    return out.distinct()


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for _, _, data, off in tv.chunks(batch.column("text")):
            h, edge = shingle_sets(data, off)
            yield set_keys(h, edge), h, edge


def links(docs: DataFrame, described: DataFrame, named: DataFrame) -> DataFrame:
    """Edges (a, b) between sets whose components are those of all links."""
    parts = tv.shuffle_parts(docs)
    schema, kinds = "part int, sig binary, v binary, role binary", {"sig": "u4", "v": "i8", "role": "i1"}
    sent = docs.select("text").mapInArrow(tv.lean(_sender(parts)), schema)
    met = gathered(durable(tv.exchange(sent, kinds, parts, _groups, "gid long, a long, b long, n long")))
    pairs = met.where("gid IS NULL").groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= LIKELY)
    if not named.where("spare0 < 0 OR spare1 < 0").isEmpty():
        pairs = pairs.union(sought(docs, named).withColumn("n", F.lit(MUST)))
    pairs = gathered(durable(likely(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), described, named)))
    # each vertex first tries the smaller vertex it shares most signatures with
    tried = gathered(durable(pairs.groupBy("b").agg(F.max_by("a", F.struct("n", F.col("a"))).alias("a")).select("a", "b")))
    edges = gathered(durable(verified(tried, docs, named)))
    roots = gathered(durable(components(edges)))
    rest = gathered(durable(_apart(pairs.join(tried, ["a", "b"], "left_anti"), roots)))
    if not rest.isEmpty():
        edges = gathered(durable(edges.union(verified(rest, docs, named))))
    members = gathered(durable(_unsettled(met, named)))
    known, whole = None, False
    while True:
        roots = gathered(durable(components(edges)))
        told = gathered(durable(members.join(roots, "v", "left").select("gid", "v", F.coalesce("root", "v").alias("root"))))
        told = gathered(durable(_merged(told)))
        if told.isEmpty():
            return edges
        if known is None:
            known = durable(sketches_of(told.select("v").distinct(), described, named).join(named.select("v", "n_shingles"), "v"))
        more = gathered(durable(_hidden(told, known, whole)))
        # of a member's best partners in several groups the best one is tried
        best = more.where("worth IS NOT NULL").groupBy("a").agg(F.max_by("b", F.struct("worth", "b")).alias("b"))
        best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        tried = more.where("a IS NOT NULL AND worth IS NULL").select("a", "b").union(best).distinct()
        new = gathered(durable(verified(gathered(durable(tried)), docs, named)))
        edges = gathered(durable(edges.union(new)))
        again = more.where("gid IS NOT NULL").select("gid")
        if again.isEmpty():
            return edges
        # groups that told all of their pairs are done
        members, whole = gathered(durable(told.select("gid", "v").join(again.distinct(), "gid", "left_semi"))), new.isEmpty()


def _named(described: DataFrame) -> DataFrame:
    """One row for each set: v, its smallest doc_id, own, own_id: hash and doc_id of one of its texts, row: number of one of its rows, size, spares."""
    least = [F.min("doc_id").alias("doc_id"), F.min(F.struct("own", F.col("doc_id").alias("own_id"))).alias("one"), F.min("row").alias("row"), *(F.max(c).alias(c) for c in ("n_shingles", "spare0", "spare1"))]
    return gathered(durable(described.where("v <> 0").groupBy("v").agg(*least).select("*", "one.*").drop("one")))


DESCRIBED = "doc_id long, n_shingles long, v long, sketch binary, spare0 long, spare1 long, own long, row long"


def describe(docs: DataFrame, more: str = "") -> DataFrame:
    kept = [F.col(x.split()[0]) for x in more.split(",") if x]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("own"), F.monotonically_increasing_id().alias("row"), *kept)
    return durable(rows.mapInArrow(tv.lean(_describe), DESCRIBED + ("," + more if more else "")))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    described = describe(docs.select("doc_id", "text"))
    named = _named(described)
    roots = gathered(durable(components(links(docs, described, named))))
    # most sets are a component by themselves: only those of several are contracted further
    least = named.select("v", "doc_id").join(roots, "v", "left").groupBy(F.coalesce("root", "v").alias("root")).agg(F.min("doc_id").alias("component_id"))
    linked = roots.join(least, "root").select("v", "component_id")
    names = named.select("v", "doc_id").join(linked, "v", "left").select("v", F.when(F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    told = described.select("doc_id", "n_shingles", "v").join(names, "v", "left")
    return told.select("doc_id", "n_shingles", F.when(F.col("v") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component: that of the smallest doc_id, rows without one last; of several with that id the one
    with the smallest hash. Rows without a word are in no component: all stay, equal rows with an id once."""
    mark = fresh(docs, "mark")
    # tells rows of one doc_id (or none) apart by all their columns, and again after a retry
    marked = docs.withColumn(mark, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    described = describe(marked.select("doc_id", "text", F.col(mark).alias("mark")), "mark long")
    roots = gathered(durable(components(links(docs, described, _named(described)))))
    last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = described.where("v <> 0").select("v", last.alias("x")).groupBy("v").agg(F.min("x").alias("x"))
    first = first.join(roots, "v", "left").groupBy(F.coalesce("root", "v")).agg(F.min("x").alias("x"))
    plain = described.where("v = 0").select(last.alias("x")).distinct()
    id_, row = fresh(docs, "id"), fresh(docs, "row")
    keep = durable(first.select("x").union(plain).select(F.col("x.doc_id").alias(id_), F.col("x.mark").alias(row)))
    kept = marked.join(keep, (F.col(mark) == F.col(row)) & F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi")
    nothing = F.col("doc_id").isNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    once = kept.where(~nothing).dropDuplicates(["doc_id", mark]).unionByName(kept.where(nothing))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
