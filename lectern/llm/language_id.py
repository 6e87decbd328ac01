"""Language ID with string kernels: blended n-gram presence, Nystroem landmarks, kernel ridge regression.

A text's features are which byte n-grams of 1 to ORDERS letters occur in it (letters in lower case, anything else
one blank), hashed to BUCKETS. The kernel of two texts is the number of features they share over the root of the
product of their numbers. Texts are read whole, in windows of about WINDOW bytes so that a long text does not
hold every n-gram there is; a text's kernel values are the means over its windows. LANDMARKS training texts span
the Nystroem space, in which one ridge regression per language is fitted; a score is the softmax of the languages'
values. Features are made AT_ONCE windows at a time, for fitting and for scoring by two matrix products, so what both hold
beside the windows themselves does not grow with the sample or with a text.

The model is fitted on about SAMPLE training documents (those with the smallest hash of doc_id and text, per language an
equal share, ten at least), from up to WINDOWS windows of each, spread over its whole text; that bound is a parameter.
Every language is learned; there are as many landmarks as languages at least. All documents and windows are scored.

Defined cases
    null text or no letter: `und`, score 0. Empty table or no labelled row: `und` for all, score 0.
    null lang: not learned from. Null doc_id: hashed like an empty id. Repeated rows: scored alike; one of them is learned
    from. Rows of one doc_id with different texts or languages: each is learned from by itself.
    very long texts: all windows. Ties: the first language by code point. Extra columns: ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lectern.llm import textvec as tv
from lectern.llm.common import durable, if_small, table

ORDERS, BUCKETS, LANDMARKS, SAMPLE, WINDOW, WINDOWS, RIDGE, SHARP = 4, 4096, 160, 3000, 1500, 8, 1e-2, 6.0
#: Windows whose features are held at a time.
AT_ONCE = 256
UNKNOWN = "und"
U = tv.U

#: ASCII letters in lower case, bytes of other letters as they are, the rest blank.
_LETTER = np.full(256, 32, np.uint8)
for _b in range(256):
    if chr(_b).isalpha() and _b < 128:
        _LETTER[_b] = ord(chr(_b).lower())
    elif _b >= 128:
        _LETTER[_b] = _b


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def windows(text: bytes, most: int | None = None) -> list[bytes]:
    """A text cut into windows; most: so many of them at most, evenly over the whole text."""
    n = max(1, round(len(text) / WINDOW))
    step = max(1, -(-len(text) // n))
    starts = np.arange(0, max(1, len(text)), step)
    if most and len(starts) > most:
        starts = starts[np.linspace(0, len(starts) - 1, most).astype(int)]
    return [text[a : a + step] for a in starts.tolist()]


def presence(parts: list[bytes], before: bytes = b"") -> np.ndarray:
    """Rows of normed presence features, one for each window; before: the byte ahead of the first."""
    x = np.zeros((len(parts), BUCKETS), np.float32)
    letter = _LETTER[np.frombuffer(before + b"".join(parts), np.uint8)].astype(U)
    size = np.array([len(p) for p in parts], np.int64)
    row, at = tv.ragged(size)
    # upper-case letters of two bytes, U+00C0 to U+00DE, in lower case
    upper = (letter[1:] >= 0x80) & (letter[1:] <= 0x9E) & (letter[:-1] == 0xC3)
    letter[1:][upper] += U(32)
    letter = letter[len(before) :]
    gram = np.zeros(len(letter), U)
    for n in range(1, ORDERS + 1):
        gram = gram[: len(letter) - n + 1] * U(257) + letter[n - 1 :] if n > 1 else letter.copy()
        if not len(gram):
            break
        ok = at[: len(gram)] + n <= size[row[: len(gram)]]
        slot = (tv.mix(gram[ok] + U(n << 56)) % U(BUCKETS)).astype(np.int64)
        x[row[: len(gram)][ok], slot] = 1
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    return x


def features(parts: list[bytes]) -> Iterator[np.ndarray]:
    """Presence features of the windows of whole texts, AT_ONCE windows at a time: a row takes 16 KB, and what finds it
    some 60 bytes for each byte of text."""
    for a in range(0, len(parts), AT_ONCE):
        yield presence(parts[a : a + AT_ONCE], parts[a - 1][-1:] if a else b"")


class Model:
    """landmarks (features), weights from kernel values to the languages' values."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    @classmethod
    def fit(cls, texts: list[list[bytes]], labels: list[str]) -> Model:
        """texts: the windows of each."""
        languages = sorted(set(labels))
        if not languages:
            return cls([], np.zeros((0, BUCKETS), np.float32), np.zeros((0, 0)))
        owner = np.repeat(np.arange(len(texts)), list(map(len, texts)))
        number = {z: k for k, z in enumerate(languages)}
        y = np.array([number[z] for z in labels])[owner]
        # landmarks in turn from each language
        turn = np.empty(len(y), np.int64)
        for k in range(len(languages)):
            turn[y == k] = np.arange((y == k).sum())
        chosen = np.lexsort((y, turn))[: max(LANDMARKS, len(languages))]
        place = np.full(len(y), -1)
        place[chosen] = np.arange(len(chosen))
        place = place[np.isin(owner, owner[chosen])]
        marks, at = np.zeros((len(chosen), BUCKETS), np.float32), 0
        for x in features([p for k in np.unique(owner[chosen]) for p in texts[k]]):
            here = place[at : at + len(x)]
            marks[here[here >= 0]] = x[here >= 0]
            at += len(x)
        weight = 1 / np.bincount(y, minlength=len(languages))[y] * len(y) / len(languages)
        # in the Nystroem space: f = (K C^-1/2) w, ridge on w; its sums are made a few windows at a time
        value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
        root = vector / np.sqrt(np.maximum(value, 1e-6 * value.max()))
        square, right, at = np.zeros((len(marks) + 1,) * 2), np.zeros((len(marks) + 1, len(languages))), 0
        for x in features([p for t in texts for p in t]):
            of = slice(at, at + len(x))
            z = np.hstack([x @ marks.T @ root, np.ones((len(x), 1))])
            target = np.where(y[of, None] == np.arange(len(languages)), 1.0, -1.0)
            square += z.T @ (z * weight[of, None])
            right += z.T @ (target * weight[of, None])
            at += len(x)
        w = np.linalg.solve(square + RIDGE * len(y) * np.eye(len(square)) / 100, right)
        return cls(languages, marks, np.vstack([root @ w[:-1], w[-1:]]))

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its score."""
        parts = [windows(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), list(map(len, parts)))
        values, at = np.zeros((len(texts), len(self.languages))), 0
        for x in features([p for t in parts for p in t]):
            np.add.at(values, owner[at : at + len(x)], np.hstack([x @ self.landmarks.T, np.ones((len(x), 1))]) @ self.weights)
            at += len(x)
        values /= np.bincount(owner, minlength=len(texts))[:, None]
        p = np.exp(SHARP * (values - values.max(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        best = values.argmax(axis=1)
        return best, p[np.arange(len(best)), best]


def _windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = [windows(t.as_py().encode("utf-8", "replace"), WINDOWS) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(cut, pa.list_(pa.binary()))], ["lang", "h", "windows"])


def training(docs: DataFrame) -> pd.DataFrame:
    """lang, h, windows of the documents to learn from: of each language those with the smallest hashes.

    A hash threshold that a few more than so many rows of the language meet comes first, so that only these are
    ordered: a language that most rows have is no hot group. Windows are cut where the text is."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (remainder(F.col("doc_id"), 4) != 2))
    span = 1 << 30
    rows = learn.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    number = durable(rows.groupBy("lang").agg(F.count("*").alias("n")))
    share = max(10, SAMPLE // max(1, number.count()))
    level = F.least(F.lit(1.0), F.lit(1.25 * share + 200) / F.col("n")) * span
    some = rows.join(if_small(number), "lang").where(F.pmod("h", F.lit(span)) < level).select("lang", "text", "h")
    by = W.partitionBy("lang").orderBy(F.pmod("h", F.lit(span)), "h")
    first = some.mapInArrow(_windowed, "lang string, h long, windows array<binary>").dropDuplicates(["lang", "h"])
    return first.withColumn("r", F.row_number().over(by)).where(F.col("r") <= share).select("lang", "h", "windows").orderBy("h", "lang").toPandas()


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    sample = training(docs)
    model = Model.fit([list(w) for w in sample["windows"]], list(sample["lang"]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            texts = batch.column("text")
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            predicted, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            for i, j, data, off in tv.chunks(texts, 1 << 20):
                rows = [k for k in range(i, j) if letters[k]] if shared.value.languages else []
                # a few windows at a time: a row of features takes 16 KB
                for part in _portions(rows, off, i):
                    best, p = shared.value.score([data[off[k - i] : off[k - i + 1]].tobytes() for k in part])
                    predicted[part], score[part] = np.array(shared.value.languages, object)[best], p
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(predicted, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    held = docs.select("doc_id", "text", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    return held.mapInArrow(tv.lean(run), "doc_id long, held_out boolean, lang_pred string, score double")


def _portions(rows: list[int], off: np.ndarray, base: int, most: int = 1 << 19) -> Iterator[list[int]]:
    part, size = [], 0
    for k in rows:
        part.append(k)
        size += int(off[k - base + 1] - off[k - base]) + WINDOW
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def held_out_by_crc(doc_id: int | None, modulus: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
