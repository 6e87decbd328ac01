"""Substring dedup by sliding sentence spans.

A run goes from a sentence over the fewest following ones, RUN sentences at least, that make LEAST words, or back
from a sentence in the same way. So a repeated passage of RUN whole sentences and LEAST words or more is covered by runs
within it, to its first and to its last sentence, whatever stands around it. Every run is hashed; equal runs meet in one
exchange; each run but the first one (by doc_id, then place) is marked, and the sentences that a marked run covers are
removed. A sentence of LONG words or more is a run by itself, so a long passage without full stops is caught as well.
Within one task only the first occurrence of a run is sent on, later ones are marked at once, so a run that
a third of all documents share reaches its reducer once per task, not once per document.

Repeated passages that hold no such run (two long sentences, parts of sentences) are found by words: every stretch
of SPAN words that also stands earlier, by (doc_id, place), is cut, be it inside a sentence or over several. Of the
SPAN - GRAM + 1 shorter stretches of GRAM words in it the one with the smallest hash is its anchor, so equal stretches
have equal anchors. The anchors of all texts meet first, about one for each 13 words; then the texts with an anchor
that stands elsewhere too send the stretches around those anchors only. No repeated stretch is lost by that.

A sentence ends at . ! ? or : ; followed by white space, or at a line's end. Sentences are compared by their
words, with A-Z in lower case and white space ignored.

Defined cases
    null or empty text: no sentences, nothing removed; null text stays null.
    repeated rows: rows of one doc_id and one text are one document, so they do not mark each other; rows of one
    doc_id with different texts are different documents. Null doc_id: one more id, the smallest. Ties cannot occur
    otherwise: places are ordered by (doc_id, hash of the text, sentence).
    a run repeated inside one document: its later occurrences are removed too.
    n_removed counts the sentences that lose all or some of their words.
    very long texts: one chunk each; empty table: empty result. Extra columns are carried by dedup().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textvec as tv
from lectern.llm.common import durable, fresh, if_small, table

RUN, LEAST, LONG = 2, 25, 40
SPAN, GRAM = 50, 25
FLUSH = 1 << 21
NO_ID = -(1 << 63)


def sentences(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the first word of each sentence (one more at the end), and of each text's first sentence; word hashes."""
    low = tv.LOWER[data]
    start, end, first = tv.words(low, off)
    n = len(start)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(off), np.int64), np.zeros(0, tv.U)
    last = low[end - 1]
    stop = np.isin(last, np.frombuffer(b".!?:;", np.uint8))
    newline = np.concatenate([[0], np.cumsum(low == 10)])
    stop[:-1] |= newline[start[1:]] > newline[end[:-1]]
    stop[first[1:][first[1:] > 0] - 1] = True
    head = np.concatenate([[0], np.flatnonzero(stop) + 1])
    return head, np.searchsorted(head, first), tv.hashes(low, start, end)


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first sentence in it, number of sentences, hash) of every compared run."""
    head, first, word = sentences(data, off)
    seq, out = tv.Sequence(word), []
    owner, at = tv.ragged(np.diff(first))
    i = np.arange(len(owner))
    ahead = np.maximum(i + RUN, np.searchsorted(head, head[i] + LEAST, "left"))
    back = np.minimum(i + 1 - RUN, np.searchsorted(head, head[i + 1] - LEAST, "right") - 1)
    ok, fits = ahead <= first[1:][owner], back >= first[:-1][owner]
    # a run has LEAST sentences at most, so first sentence and number make one integer
    runs = np.unique(np.concatenate([i[ok] * 64 + ahead[ok] - i[ok], back[fits] * 64 + i[fits] + 1 - back[fits]]))
    runs = np.stack([runs >> 6, (runs >> 6) + (runs & 63)], axis=1)
    long = i[head[i + 1] - head[i] >= LONG]
    for a, b in (runs.T, (long, long + 1)):
        out.append((owner[a], at[a], b - a, seq.of(head[a], head[b])))
    return tuple(np.concatenate(x) for x in zip(*out))


def _first(key: np.ndarray, doc: np.ndarray, own: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (key, doc, own, at), and where in it each row is neither the first of its key nor equal to that."""
    order = np.lexsort((at, own, doc, key))
    k, d, o, a = key[order], doc[order], own[order], at[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    return order, (d != d[lead]) | (o != o[lead]) | (a != a[lead])


def _mapper(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            key, doc, own, at, run = (np.concatenate(x) for x in zip(*held))
            order, late = _first(key, doc, own, at)
            key, doc, own, at, run = key[order], doc[order], own[order], at[order], run[order]
            # the key is sent with the first occurrence; later ones are marked already and need no other row
            part = (tv.mix(np.where(late, doc.view(tv.U) ^ own.view(tv.U), key)) % tv.U(parts)).astype(np.int32)
            return tv.packed({"key": key, "doc": doc, "own": own, "at": at.astype(np.int32), "run": np.where(late, -run, run).astype(np.int8)}, part, parts)

        for batch in batches:
            ids, texts = batch.column("doc_id").fill_null(NO_ID).to_numpy(), batch.column("own").to_numpy()
            for i, j, data, off in tv.chunks(batch.column("text")):
                owner, at, n, key = spans(data, off)
                if len(key):
                    held.append((key, ids[i:j][owner], texts[i:j][owner], at, n))
                    size += len(key)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _meet(columns: tv.Columns) -> Iterator[pa.RecordBatch]:
    run = columns["run"].astype(np.int64)
    known = run < 0
    key, doc, own, at = (columns[x][~known] for x in ("key", "doc", "own", "at"))
    order, late = _first(key, doc, own, at)
    late = order[late]
    doc = np.concatenate([doc[late], columns["doc"][known]])
    own = np.concatenate([own[late], columns["own"][known]])
    at = np.concatenate([at[late], columns["at"][known]])
    run = np.concatenate([run[~known][late], -run[known]])
    if not len(doc):
        return
    # sentences covered, each once in this part
    owner, k = tv.ragged(run)
    rows = np.unique(np.rec.fromarrays([doc[owner], own[owner], at[owner] + k], names="d,o,s"))
    for i in range(0, len(rows), 1 << 18):
        some = rows[i : i + (1 << 18)]
        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(some[x])) for x in "do"), pa.array(some["s"].astype(np.int32))], ["doc", "own", "s"])


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("own"), "doc_id", "text")


def removed(docs: DataFrame) -> DataFrame:
    """doc, own, gone: the sorted numbers of the sentences to remove, of every document that loses any."""
    parts = tv.shuffle_parts(docs)
    sent = _named(docs).mapInArrow(tv.lean(_mapper(parts)), "part int, key binary, doc binary, own binary, at binary, run binary")
    kinds = {"key": "u8", "doc": "i8", "own": "i8", "at": "i4", "run": "i1"}
    rows = tv.exchange(sent, kinds, parts, _meet, "doc long, own long, s int")
    return rows.groupBy("doc", "own").agg(F.array_sort(F.collect_set("s")).alias("gone"))


def stretches(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in it, place of the anchor in it, hash of the anchor, hash) of every stretch of SPAN words."""
    low = tv.LOWER[data]
    start, end, first = tv.words(low, off)
    owner, at = tv.ragged(np.maximum(np.diff(first) - SPAN + 1, 0))
    if not len(owner):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(tv.U), none.view(tv.U)
    seq = tv.Sequence(tv.hashes(low, start, end))
    a = first[:-1][owner] + at
    g = np.arange(len(start) - GRAM + 1)
    gram = seq.of(g, g + GRAM)
    # the first smallest one of each SPAN - GRAM + 1, over 1, 2, 4... of them and then the rest
    least, step, width = g, 1, SPAN - GRAM + 1
    while step < width:
        by = min(step, width - step)
        left, right = least[:-by], least[by:]
        least, step = np.where(gram[right] < gram[left], right, left), step + by
    least = least[a]
    return owner, at, least - first[:-1][owner], gram[least], seq.of(a, a + SPAN)


ANCHORS = {"key": "u8", "doc": "i8", "own": "i8", "state": "i1"}
#: Of an anchor: the only one in its task, the first of several there, a later one (which needs to meet no other).
ALONE, SEVERAL, LATER = 0, 1, 2


def _anchors(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            key, doc, own, at = (np.concatenate(x) for x in zip(*held))
            order, late = _first(key, doc, own, at)
            key, doc, own = key[order], doc[order], own[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            several = np.logical_or.reduceat(late, np.flatnonzero(new))[np.cumsum(new) - 1]
            state = np.where(late, LATER, np.where(several, SEVERAL, ALONE)).astype(np.int8)
            # of a document's later ones with the same key one tells as much as all
            take = new.copy()
            take[1:] |= late[1:] & ((doc[1:] != doc[:-1]) | (own[1:] != own[:-1]) | ~late[:-1])
            key, doc, own, state = key[take], doc[take], own[take], state[take]
            part = (tv.mix(np.where(state == LATER, doc.view(tv.U) ^ own.view(tv.U), key)) % tv.U(parts)).astype(np.int32)
            return tv.packed({"key": key, "doc": doc, "own": own, "state": state}, part, parts)

        for batch in batches:
            ids, texts = batch.column("doc_id").fill_null(NO_ID).to_numpy(), batch.column("own").to_numpy()
            for i, j, data, off in tv.chunks(batch.column("text")):
                owner, _, place, anchor, _ = stretches(data, off)
                if not len(owner):
                    continue
                # neighbouring stretches mostly have one anchor
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
                held.append((anchor[new], ids[i:j][owner[new]], texts[i:j][owner[new]], place[new]))
                size += int(new.sum())
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _meet_anchors(c: tv.Columns) -> Iterator[pa.RecordBatch]:
    """doc, own, key of every anchor that stands at several places."""
    later = c["state"] == LATER
    key, doc, own, state = (c[x][~later] for x in ("key", "doc", "own", "state"))
    order = np.lexsort((own, doc, key))
    key, doc, own, state = key[order], doc[order], own[order], state[order]
    take = np.zeros(len(key), bool)
    if len(key):
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(key)) - 1
        many = (doc[at] != doc[last]) | (own[at] != own[last]) | (np.maximum.reduceat(state, at) == SEVERAL)
        take = many[np.cumsum(new) - 1]
    doc, own, key = (np.concatenate([x[take], c[y][later]]) for x, y in ((doc, "doc"), (own, "own"), (key, "key")))
    for i in range(0, len(doc), 1 << 18):
        yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 18)].view(np.int64)) for x in (doc, own, key)], ["doc", "own", "key"])


def _merged(doc: np.ndarray, own: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words a to b of each text, with stretches that meet or overlap as one; all are SPAN words or more."""
    order = np.lexsort((b, a, own, doc))
    doc, own, a, b = doc[order], own[order], a[order], b[order]
    if not len(doc):
        return doc, own, a, b
    # the furthest end so far: ends are lifted by text, so that one text's never reach into the next
    text = np.concatenate([[0], np.cumsum((doc[1:] != doc[:-1]) | (own[1:] != own[:-1]))])
    lift = text * (int(b.max()) + 2)
    reach = np.maximum.accumulate(b + lift)
    new = np.ones(len(doc), bool)
    new[1:] = (a + lift)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], own[at], a[at], np.maximum.reduceat(b, at)


STRETCHES = {"key": "u8", "doc": "i8", "own": "i8", "at": "i4", "end": "i4"}


def _stretches(parts: int):
    """Sends the wanted stretches, those of one anchor to one part; what is late in this task goes as merged stretches with their ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            key, doc, own, at, anchor = (np.concatenate(x) for x in zip(*held))
            order, late = _first(key, doc, own, at)
            late, one = order[late], order[np.concatenate([[True], key[order][1:] != key[order][:-1]])]
            d, o, a, b = _merged(doc[late], own[late], at[late], at[late] + SPAN)
            part = np.concatenate([tv.mix(anchor[one]), tv.mix(d.view(tv.U) ^ o.view(tv.U))]) % tv.U(parts)
            out = {"key": np.append(key[one], np.zeros(len(d), tv.U)), "doc": np.append(doc[one], d), "own": np.append(own[one], o)}
            out |= {"at": np.append(at[one], a).astype(np.int32), "end": np.append(np.zeros(len(one), np.int64), b).astype(np.int32)}
            return tv.packed(out, part.astype(np.int32), parts)

        for batch in batches:
            ids, texts, wanted = batch.column("doc_id").fill_null(NO_ID).to_numpy(), batch.column("own").to_numpy(), batch.column("wanted")
            for i, j, data, off in tv.chunks(batch.column("text")):
                owner, at, _, anchor, key = stretches(data, off)
                pick = wanted.slice(i, j - i)
                mine = np.repeat(np.arange(j - i), np.diff(pick.offsets.to_numpy()))
                # by a hash of text and anchor; a stretch too many does no harm
                named = lambda text, key: tv.mix(tv.mix(text.astype(tv.U)) ^ key.view(tv.U))
                take = np.isin(named(owner, anchor), named(mine, pick.flatten().to_numpy()))
                if take.any():
                    held.append((key[take], ids[i:j][owner[take]], texts[i:j][owner[take]], at[take], anchor[take]))
                    size += int(take.sum())
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _meet_stretches(c: tv.Columns) -> Iterator[pa.RecordBatch]:
    known = c["end"] > 0
    key, doc, own, at = (c[x][~known] for x in ("key", "doc", "own", "at"))
    order, late = _first(key, doc, own, at)
    late = order[late]
    a = np.concatenate([at[late], c["at"][known]]).astype(np.int64)
    b = np.concatenate([at[late] + SPAN, c["end"][known]]).astype(np.int64)
    doc, own, a, b = _merged(np.concatenate([doc[late], c["doc"][known]]), np.concatenate([own[late], c["own"][known]]), a, b)
    for i in range(0, len(doc), 1 << 18):
        yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 18)]) for x in (doc, own, a, b)], ["doc", "own", "a", "b"])


def passages(docs: DataFrame) -> DataFrame:
    """doc, own, cut: the stretches (a, b) of words, b being the first one after it, of which SPAN and more also stand earlier."""
    parts = tv.shuffle_parts(docs)
    binary = lambda kinds: "part int, " + ", ".join(f"{k} binary" for k in kinds)
    named = _named(docs)
    met = durable(tv.exchange(named.mapInArrow(tv.lean(_anchors(parts)), binary(ANCHORS)), ANCHORS, parts, _meet_anchors, "doc long, own long, key long"))
    wanted = durable(met.groupBy("doc", "own").agg(F.collect_set("key").alias("wanted")))
    some = named.join(if_small(wanted.select("doc", "own"), 16), ["doc", "own"], "left_semi").join(wanted, ["doc", "own"]).select("doc_id", "own", "text", "wanted")
    rows = tv.exchange(some.mapInArrow(tv.lean(_stretches(parts)), binary(STRETCHES)), STRETCHES, parts, _meet_stretches, "doc long, own long, a long, b long")
    return rows.groupBy("doc", "own").agg(F.collect_list(F.struct("a", "b")).alias("cut"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every text, and the text without its removed sentences and stretches of words, which the last two columns tell."""
    for batch in batches:
        rest = {"n_sentences": [], "n_removed": [], "new_text": []}
        gone, cut, texts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1), batch.column("text")
        for i, j, data, off in tv.chunks(texts):
            head, first, _ = sentences(data, off)
            start, _, word = tv.words(data, off)
            for k in range(i, j):
                a, b = first[k - i], first[k - i + 1]
                n, lost, spans = int(b - a), gone[k].as_py(), cut[k].as_py()
                rest["n_sentences"].append(n)
                if not lost and not spans:
                    rest["n_removed"].append(0)
                    rest["new_text"].append(texts[k].as_py())
                    continue
                low, high = word[k - i], word[k - i + 1]
                edge = np.append(start[low:high], off[k - i + 1])
                begin = head[a : b + 1] - low
                keep = np.ones(high - low, bool)
                for x in lost or ():
                    if x < n:
                        keep[begin[x] : begin[x + 1]] = False
                for x in spans or ():
                    keep[x["a"] : x["b"]] = False
                rest["n_removed"].append(int((~np.logical_and.reduceat(keep, begin[:-1])).sum()))
                turn = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]])))
                pieces = [data[edge[x] : edge[y]].tobytes() for x, y in zip(turn[::2], turn[1::2])]
                rest["new_text"].append(b"".join([data[off[k - i] : edge[0]].tobytes(), *pieces]).decode("utf-8", "replace"))
        names, arrays = batch.schema.names[:-2], list(batch.columns)[:-2]
        arrays[names.index("text")] = pa.array(rest["new_text"], pa.string())
        for name in ("n_sentences", "n_removed"):
            arrays.append(pa.array(rest[name], pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, [*names, "n_sentences_", "n_removed_"])


def dedup(docs: DataFrame) -> DataFrame:
    """docs with the repeated sentences and passages cut out of text, and __n_sentences and __n_removed (with an
    underscore more for each column of docs that has that name)."""
    gone = durable(removed(docs).join(passages(docs), ["doc", "own"], "full_outer"))
    doc, own, lost, cut = (fresh(docs, c) for c in ("doc", "own", "gone", "cut"))
    d = docs.withColumn(doc, F.coalesce(F.col("doc_id"), F.lit(NO_ID))).withColumn(own, F.xxhash64("text"))
    joined = d.join(gone.withColumnsRenamed({"doc": doc, "own": own, "gone": lost, "cut": cut}), [doc, own], "left").select(*[F.col(f"`{c}`") for c in docs.columns], lost, cut)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {fresh(docs, 'n_sentences')} long, {fresh(docs, 'n_removed')} long"
    return joined.mapInArrow(tv.lean(_cut), schema)


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_sentences").alias("n_sentences"), F.col("__n_removed").alias("n_removed"), "text")
