"""Line dedup with a deletion-neighbourhood join; the earliest of near-equal lines stays.

Lines are compared by their words, A-Z in lower case. A line goes if an earlier line (by doc_id, then place)
has the same words, or, where both have at least LEAST words, differs from it by one edited word: one replaced,
one inserted or one deleted. Every line compared for that sends its words' hash and that of each variant with one
word deleted. In a group of equal keys,
    variants without the word at the same place differ by that one word: all but the earliest line go;
    a whole line and any variant differ by the deleted word: whichever comes later goes.
So a group needs its earliest members only, never its pairs. Every line found so is compared with the line that
condemns it, word by word, before it goes.

A line with one edit shares its first or its last half with its partner. So the neighbourhoods, as many keys as
there are words, are only sent for lines of which a half also occurs in some other line; no link is lost by that.
Equal lines within a task are marked at once and sent once; of the lines of a task that share a half, or a variant,
only the ends of the group are sent, and the others are marked there. So a template line that a third of all documents
vary costs its readers a few rows for each task.

Defined cases
    null or empty text: no lines, nothing removed; null text stays null. Lines without a word: always kept.
    repeated rows: rows of one doc_id and one text are one document and do not mark each other; rows of one doc_id
    with different texts are different documents, ordered by the hash of the text (`own`), as are rows with a null
    doc_id, which comes before all others.
    very long texts and lines: whole. Empty table: empty result. Extra columns are carried by dedup().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textvec as tv
from lectern.llm.common import durable, fresh, if_small, table

LEAST = 8
FLUSH = 1 << 20
NO_ID = -(1 << 63)
U = tv.U


def lines(data: np.ndarray, off: np.ndarray):
    """For each line with a word: text, number of the line in it (from 0), first and end word; the words' hashes."""
    low = tv.LOWER[data]
    start, end, first = tv.words(low, off)
    word = tv.hashes(low, start, end)
    breaks = np.concatenate([[0], np.cumsum(low == 10)])
    owner = np.repeat(np.arange(len(off) - 1), np.diff(first))
    number = breaks[start] - breaks[off[:-1]][owner]
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])
    a = np.flatnonzero(new)
    return owner[a], number[a], a, np.append(a[1:], len(start)), word


def _first(key: np.ndarray, *place: np.ndarray):
    """Order by key and place; in it, whether a new key begins and where each row's key began."""
    order = np.lexsort((*place[::-1], key))
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    return order, new, np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    return (tv.mix(key) % U(parts)).astype(np.int32)


HALVES = {"key": "u8", "whole": "u8", "doc": "i8", "own": "i8", "line": "i4", "kind": "i1"}
WHOLE, HALF, KNOWN, TOLD = 0, 1, 2, 3


def _halves(parts: int):
    """Sends each line's words' hash and the hashes of its halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            whole, doc, own, line, *half, n = (np.concatenate(x) for x in zip(*held))
            order, _, lead = _first(whole, doc, own, line)
            w, d, o, i = whole[order], doc[order], own[order], line[order]
            late = (d != d[lead]) | (o != o[lead]) | (i != i[lead])
            once = np.zeros(len(w), bool)
            once[order[lead]] = True
            long = once & (n >= LEAST)
            a, b = half[0] != half[2], half[1] != half[3]
            out = [(whole[once], whole[once], doc[once], own[once], line[once], np.full(int(once.sum()), WHOLE))]
            # of the lines that share a half here the ones with the smallest and largest hash are sent, the others are told
            of = np.concatenate([np.flatnonzero(m) for m in (long, long, long & a, long & b)])
            key = np.concatenate([k[m] for k, m in zip(half, (long, long, long & a, long & b))])
            order = np.lexsort((whole[of], key))
            of, key = of[order], key[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
            last = np.concatenate([key[1:] != key[:-1], [True]])[: len(key)]
            for m, kind in ((first | last, HALF), (~(first & last), TOLD)):
                at, k = of[m], key[m]
                if kind == TOLD:
                    at = np.unique(at)
                    k = doc[at].view(U) ^ own[at].view(U)
                out.append((k, whole[at], doc[at], own[at], line[at], np.full(len(at), kind)))
            out.append((d[late].view(U) ^ o[late].view(U), w[late], d[late], o[late], i[late], np.full(int(late.sum()), KNOWN)))
            key, whole, doc, own, line, kind = (np.concatenate(x) for x in zip(*out))
            return tv.packed({"key": key, "whole": whole, "doc": doc, "own": own, "line": line.astype(np.int32), "kind": kind.astype(np.int8)}, _part(key, parts), parts)

        for batch in batches:
            ids, own = batch.column("doc_id").fill_null(NO_ID).to_numpy(), batch.column("own").to_numpy()
            for i, j, data, off in tv.chunks(batch.column("text")):
                owner, number, a, b, word = lines(data, off)
                if not len(a):
                    continue
                seq, n = tv.Sequence(word), b - a
                half = []
                for h in (n // 2, (n - 1) // 2):
                    half += [tv.mix(seq.of(a, a + h) ^ U(1)), tv.mix(seq.of(b - h, b) ^ U(2))]
                held.append((seq.of(a, b), ids[i:j][owner], own[i:j][owner], number, *half, n))
                size += len(a)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _rows(kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = ["kind", "doc", "own", "line", "by_doc", "by_own", "by_line"]
    zero = np.zeros(len(columns[0]), np.int64)
    columns = [np.asarray(c, np.int64) for c in (*columns, zero, zero, zero)[:6]]
    for i in range(0, len(columns[0]), 1 << 18):
        some = [pa.array(c[i : i + (1 << 18)]) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some[0]), kind, np.int64)), *some], names)


FOUND = "kind long, doc long, own long, line long, by_doc long, by_own long, by_line long"
EXACT, SUSPECT, NEAR = 0, 1, 2


def _meet_halves(c: tv.Columns) -> Iterator[pa.RecordBatch]:
    m = c["kind"] == KNOWN
    yield from _rows(EXACT, c["doc"][m], c["own"][m], c["line"][m])
    m = c["kind"] == WHOLE
    order, _, lead = _first(c["key"][m], c["doc"][m], c["own"][m], c["line"][m])
    d, o, i = c["doc"][m][order], c["own"][m][order], c["line"][m][order]
    late = (d != d[lead]) | (o != o[lead]) | (i != i[lead])
    yield from _rows(EXACT, d[late], o[late], i[late])
    m = c["kind"] == TOLD
    yield from _rows(SUSPECT, c["doc"][m], c["own"][m], c["line"][m])
    m = c["kind"] == HALF
    order, new, _ = _first(c["key"][m], c["whole"][m])
    if not len(order):
        return
    w, at = c["whole"][m][order], np.flatnonzero(new)
    several = np.minimum.reduceat(w, at) != np.maximum.reduceat(w, at)
    take = several[np.cumsum(new) - 1]
    yield from _rows(SUSPECT, c["doc"][m][order][take], c["own"][m][order][take], c["line"][m][order][take])


LATE, BY = -2, -3
VARIANTS = {"key": "u8", "doc": "i8", "own": "i8", "line": "i4", "at": "i4"}


def _variants(parts: int):
    """Sends the deletion neighbourhood of every suspect line; at: the deleted word's place, -1 for none. A variant that
    an earlier line of this task has at the same place is not sent; the line and that earlier one go as LATE and BY."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            key, doc, own, line, at = (np.concatenate(x) for x in zip(*held))
            order, _, lead = _first(tv.mix(key ^ tv.mix((at + 2).astype(U))), doc, own, line)
            key, doc, own, line, at = key[order], doc[order], own[order], line[order], at[order]
            late = (at >= 0) & ((doc != doc[lead]) | (own != own[lead]) | (line != line[lead]))
            x = np.flatnonzero(late)
            token = tv.mix(doc[x].view(U) ^ tv.mix(own[x].view(U) ^ tv.mix(line[x].astype(U))))
            token, once = np.unique(token, return_index=True)
            x = x[once]
            rows = {"key": key, "doc": doc, "own": own, "line": line, "at": at}
            rest = [x, lead[x]]
            rows = {n: np.concatenate([c[~late], *(c[i] for i in rest)]) for n, c in rows.items()}
            rows["key"] = np.concatenate([key[~late], token, token])
            rows["at"] = np.concatenate([at[~late], np.full(len(x), LATE), np.full(len(x), BY)]).astype(np.int32)
            rows["line"] = rows["line"].astype(np.int32)
            return tv.packed(rows, _part(rows["key"], parts), parts)

        for batch in batches:
            ids, wanted = batch.column("doc_id").fill_null(NO_ID).to_numpy(), batch.column("wanted")
            texts = batch.column("own").to_numpy()
            for i, j, data, off in tv.chunks(batch.column("text")):
                owner, number, a, b, word = lines(data, off)
                pick = [np.asarray(wanted[k].as_py(), np.int64) for k in range(i, j)]
                mine = np.repeat(np.arange(j - i), list(map(len, pick)))
                pick = np.concatenate(pick)
                width = int(max(number.max(initial=0), pick.max(initial=0))) + 1
                take = np.isin(owner * width + number, mine * width + pick)
                owner, number, a, b = owner[take], number[take], a[take], b[take]
                if not len(a):
                    continue
                seq, n = tv.Sequence(word), b - a
                who, at = tv.ragged(n)
                doc, own = ids[i:j][owner], texts[i:j][owner]
                held.append((seq.of(a, b), doc, own, number, np.full(len(a), -1)))
                held.append((seq.without(a[who], b[who], a[who] + at), doc[who], own[who], number[who], at))
                size += len(a) + len(who)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _meet_variants(c: tv.Columns) -> Iterator[pa.RecordBatch]:
    key, doc, own, line, at = c["key"], c["doc"], c["own"], c["line"], c["at"]

    def late(mask, key):
        order, _, lead = _first(key[mask], doc[mask], own[mask], line[mask])
        d, o, i = doc[mask][order], own[mask][order], line[mask][order]
        gone = (d != d[lead]) | (o != o[lead]) | (i != i[lead])
        return d[gone], o[gone], i[gone], d[lead][gone], o[lead][gone], i[lead][gone]

    # what a task has found: each line of LATE, with any of its lines of BY
    pair = [np.flatnonzero(at == kind) for kind in (LATE, BY)]
    x, y = (p[np.argsort(key[p], kind="stable")] for p in pair)
    yield from _rows(NEAR, doc[x], own[x], line[x], doc[y], own[y], line[y])
    key, doc, own, line, at = (c[at > LATE] for c in (key, doc, own, line, at))
    whole = at < 0
    # one word replaced: equal keys without the word at the same place
    yield from _rows(NEAR, *late(~whole, tv.mix(key ^ tv.mix((at + 2).astype(U)))))
    # one word more or less: the earliest whole line against variants, the earliest variant against whole lines
    both = np.isin(key, np.intersect1d(key[whole], key[~whole]))
    for one, other in ((whole, ~whole), (~whole, whole)):
        m, n = both & one, both & other
        order, new, _ = _first(key[m], doc[m], own[m], line[m])
        head = order[new]
        k, d, o, i = key[m][head], doc[m][head], own[m][head], line[m][head]
        if not len(k):
            continue
        by = np.searchsorted(k, key[n])
        text = (o[by] < own[n]) | ((o[by] == own[n]) & (i[by] < line[n]))
        later = (d[by] < doc[n]) | ((d[by] == doc[n]) & text)
        yield from _rows(NEAR, doc[n][later], own[n][later], line[n][later], d[by][later], o[by][later], i[by][later])


def one_edit(a: list[str], b: list[str]) -> bool:
    """Whether two lists of words differ by at most one edited word."""
    if abs(len(a) - len(b)) > 1:
        return False
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def _checked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        ok = [one_edit(list(x), list(y)) for x, y in zip(f["words"], f["by_words"])]
        yield f.loc[ok, ["doc", "own", "line"]]


def removed(docs: DataFrame) -> DataFrame:
    """doc, own, line, near: every line to remove, and whether only a near-equal line condemns it."""
    parts = tv.shuffle_parts(docs)
    d = docs.select("doc_id", F.xxhash64("text").alias("own"), "text")
    binary = lambda kinds: "part int, " + ", ".join(f"{k} binary" for k in kinds)
    first = durable(tv.exchange(d.mapInArrow(tv.lean(_halves(parts)), binary(HALVES)), HALVES, parts, _meet_halves, FOUND))
    exact = first.where(F.col("kind") == EXACT).select("doc", "own", "line").distinct()
    suspect = first.where(F.col("kind") == SUSPECT).select("doc", "own", "line").distinct()
    # lines that are gone already condemn nothing that their first copy does not
    suspect = durable(suspect.join(exact, ["doc", "own", "line"], "left_anti").groupBy("doc", "own").agg(F.collect_list("line").alias("wanted")))
    named = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("own"), "doc_id", "text")
    again = named.join(if_small(suspect, F.lit(40) + 8 * F.size("wanted")), ["doc", "own"]).select("doc_id", "own", "text", "wanted")
    near = durable(tv.exchange(again.mapInArrow(tv.lean(_variants(parts)), binary(VARIANTS)), VARIANTS, parts, _meet_variants, FOUND))
    # one witness for each line suffices: within a group the earliest line is near to all
    pairs = durable(near.select("doc", "own", "line", "by_doc", "by_own", "by_line").distinct())
    named_lines = pairs.select("doc", "own", "line").union(pairs.select("by_doc", "by_own", "by_line")).distinct()
    some = named.join(if_small(durable(named_lines.select("doc", "own").distinct()), 16), ["doc", "own"], "left_semi")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = some.dropDuplicates(["doc", "own"]).select("doc", "own", F.posexplode(F.split("text", "\n")).alias("line", "t")).withColumn("line", F.col("line").cast("long"))
    text = text.join(named_lines, ["doc", "own", "line"], "left_semi")
    text = durable(text.select("doc", "own", "line", F.array_remove(F.split(F.translate("t", upper, lower), r"[\x20\x09-\x0D]+"), "").alias("words")))
    by = text.select(*[F.col(c).alias(f"by_{c}") for c in text.columns])
    told = pairs.join(text, ["doc", "own", "line"]).join(by, ["by_doc", "by_own", "by_line"])
    near = told.select("doc", "own", "line", "words", "by_words").mapInPandas(_checked, "doc long, own long, line long").distinct()
    return exact.withColumn("near", F.lit(False)).union(near.join(exact, ["doc", "own", "line"], "left_anti").withColumn("near", F.lit(True)))


def dedup(docs: DataFrame) -> DataFrame:
    """docs with the removed lines cut out of text, and __exact and __near, the numbers of removed lines (with an
    underscore more for each column of docs that has that name)."""
    doc, own, lost, exact, near = (fresh(docs, c) for c in ("doc", "own", "gone", "exact", "near"))
    gone = removed(docs).groupBy(F.col("doc").alias(doc), F.col("own").alias(own)).agg(
        F.array_sort(F.collect_set("line")).alias(lost),
        F.count_if(~F.col("near")).alias(exact),
        F.count_if("near").alias(near),
    )
    named = docs.withColumn(doc, F.coalesce(F.col("doc_id"), F.lit(NO_ID))).withColumn(own, F.xxhash64("text"))
    joined = named.join(gone, [doc, own], "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(lost, i.cast("long"))), "\n")
    columns = [F.when(F.col(lost).isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (exact, near)])


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """As dedup(), with the columns of docs only; n_chars follows the text and documents left without a word go."""
    out = dedup(docs).select(*[F.col(f"`{c}`") for c in docs.columns]).where(F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__exact").alias("n_exact"), F.col("__near").alias("n_near"), "text")


ORACLE = r"""
WITH l AS (SELECT doc_id, i - 1 AS line, string_split(text, chr(10))[i] AS t FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)),
w AS (SELECT doc_id, line, t, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM l),
k AS (SELECT doc_id, line, w, len(w) AS n, array_to_string(w, ' ') AS key,
    row_number() OVER (PARTITION BY w ORDER BY doc_id, line) AS copy FROM w WHERE len(w) > 0),
f AS (SELECT * FROM k WHERE copy = 1 AND n >= 8),
v AS (SELECT doc_id, line, n, i, array_to_string(list_concat(w[:i-1], w[i+1:]), ' ') AS key FROM f, unnest(range(1, n + 1)) AS u(i)),
s AS (SELECT doc_id, line, row_number() OVER (PARTITION BY n, i, key ORDER BY doc_id, line) AS r FROM v),
near AS (
  SELECT doc_id, line FROM s WHERE r > 1
  UNION SELECT v.doc_id, v.line FROM v JOIN f ON v.key = f.key WHERE (f.doc_id, f.line) < (v.doc_id, v.line)
  UNION SELECT f.doc_id, f.line FROM v JOIN f ON v.key = f.key WHERE (v.doc_id, v.line) < (f.doc_id, f.line)),
g AS (SELECT w.doc_id, w.line, w.t, coalesce(k.copy > 1, false) AS exact, coalesce(k.copy = 1, false) AND near.line IS NOT NULL AS near
  FROM w LEFT JOIN k USING (doc_id, line) LEFT JOIN near USING (doc_id, line))
SELECT doc_id, count(*) FILTER (exact) AS n_exact, count(*) FILTER (near) AS n_near,
  coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (NOT exact AND NOT near), '') AS text FROM g GROUP BY doc_id
"""
