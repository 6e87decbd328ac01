"""Extra columns with the names that operators use themselves, rows without ids, and equal rows of one id."""

import random

import corpus_pipeline as cp
import numpy as np
from pyspark.sql import functions as F

from lectern.llm import language_id as li
from lectern.llm import line_dedup, mixing, ngram_join, sentence_spans
from lectern.llm import quality_classifier as qc
from lectern.llm import quality_rules as qr
from tests.llm.fixtures import DOCS, awkward_docs, prose, rows

NAMES = ("own", "doc", "gone", "cut", "line", "near", "v", "h", "mark", "size", "t", "__doc", "__own", "__gone", "__EXACT", "__near", "__times", "__id", "__hash", "__copy", "__rules_kept", "__mark", "__n_removed", "__cut")


def clashing(docs):
    return docs.withColumns({n: F.lit(n) for n in NAMES if n != "own"} | {"own": F.lit("own")})


def corpus(spark):
    texts = [prose(i, 60) + "\n" + prose(900 + i % 4, 30) for i in range(24)]
    return spark.createDataFrame(rows(texts) + [(3, texts[3], "en", "src0", 0), (3, prose(77, 40), "en", "src0", 0), (None, texts[4], "en", None, 0), (None, None, None, None, None), (7, "", "en", "src0", 0)], DOCS)


def test_clashing_names_change_nothing(spark):
    docs = corpus(spark)
    wide = clashing(docs)
    for apply in (lambda d: line_dedup.dedup(d), line_dedup.without_repeated_lines, sentence_spans.dedup, mixing.mix, qr.apply_rules, ngram_join.one_of_each):
        plain, extra = apply(docs), apply(wide)
        assert extra.columns[: len(wide.columns)] == wide.columns
        get = lambda df: sorted((tuple(r) for r in df.select(*docs.columns).collect()), key=str)
        assert get(plain) == get(extra)
        assert all(r[n] == n for r in extra.limit(3).collect() for n in NAMES)
    for apply in (mixing.plan, li.identify, ngram_join.join, qr.figures):
        assert apply(wide).count() == docs.count()


def test_stages_take_awkward_rows_and_empty_tables(spark):
    for docs in (awkward_docs(spark), corpus(spark), corpus(spark).limit(0)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, "")
            assert out.count() >= 0
            if name != "packing":
                assert out.columns == docs.columns


def test_languages_of_repeated_ids_and_null_texts(spark):
    rng = random.Random(5)
    words = {f"l{k}": [f"{chr(97 + k % 26)}{chr(97 + (k * 7 + j) % 26)}{chr(97 + (k * 3 + j) % 26)}" for j in range(6)] for k in range(30)}
    data = [(i % 400, " ".join(rng.choice(words[lang]) for _ in range(60)), lang, "s", 0) for i, lang in enumerate(list(words) * 20)]
    data += [(i, None, "l1", "s", 0) for i in range(50)] + [(None, "aaa bbb", "l2", "s", 0)] * 2
    out = li.identify(spark.createDataFrame(data, DOCS).repartition(3)).collect()
    assert len(out) == len(data) and {r.lang_pred for r in out} >= set(words)


def test_every_language_is_learned_however_many():
    texts = [[f"{chr(97 + k % 26)}{chr(97 + k // 26)}".encode() * 30] for k in range(400)]
    model = li.Model.fit(texts, [f"l{k:03}" for k in range(400)])
    assert len(model.languages) == 400 and len(model.landmarks) == 400


def test_kernel_values_equal_plain_sets():
    texts = ["Das ist ein Satz.", "Une très belle ÉCOLE !", "x", "no 1 two"]

    def features(text):
        data = bytearray(text.encode())
        for i, b in enumerate(data):
            if b < 128:
                data[i] = ord(chr(b).lower()) if chr(b).isalpha() else 32
            elif i and data[i - 1] == 0xC3 and 0x80 <= b <= 0x9E:
                data[i] = b + 32
        grams = {bytes(data[i : i + n]) for n in range(1, li.ORDERS + 1) for i in range(len(data) - n + 1)}
        out = set()
        for g in grams:
            x = 0
            for c in g:
                x = x * 257 + c
            out.add(int(li.tv.mix(np.array([x + (len(g) << 56)], np.uint64))[0]) % li.BUCKETS)
        return out

    x = li.presence([t.encode() for t in texts])
    sets = [features(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert abs(float(x[i] @ x[j]) - len(a & b) / (len(a) * len(b)) ** 0.5) < 1e-5


def test_word_vectors_and_pooling_equal_plain_loops(spark):
    texts = ["a b a b b c!", "", "x  y,, z", "one two three two one"]
    index = qc.index_vectors()
    want = np.zeros((qc.BUCKETS, qc.DIMENSIONS))
    tokens = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        tokens.append(qc.tokens(data, np.array([0, len(data)]))[0].tolist())
        for i, token in enumerate(tokens[-1]):
            for j in range(max(0, i - qc.REACH), min(len(tokens[-1]), i + qc.REACH + 1)):
                if j != i:
                    want[token] += index[tokens[-1][j]]
    vectors = qc.word_vectors(spark.createDataFrame(rows(texts), DOCS).repartition(3))
    assert np.allclose(vectors, qc.unit(want), atol=1e-6)
    joined = "".join(texts).encode()
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    pooled = qc.pooled(np.frombuffer(joined, np.uint8), off, vectors)
    for row, own in zip(pooled, tokens):
        x = vectors[own] if own else np.zeros((1, qc.DIMENSIONS))
        assert np.allclose(row, np.concatenate([x.mean(axis=0), x.std(axis=0)]), atol=1e-3)


def test_sets_of_weak_signatures_are_sought_by_their_elements(spark):
    base = prose(1, 90)
    texts = [base, base + " more", "an other text " + prose(2, 80), prose(3, 40), prose(3, 40) + " x"]
    docs = spark.createDataFrame(rows(texts), DOCS)
    described = ngram_join.describe(docs)
    named = ngram_join._named(described)
    weak = named.withColumn("spare0", F.when(F.col("doc_id").isin(0, 4), -1).otherwise(F.col("spare0")))
    v = {r.doc_id: r.v for r in named.collect()}
    got = {tuple(r) for r in ngram_join.sought(docs, weak).collect()}
    assert got == {tuple(sorted((v[0], v[1]))), tuple(sorted((v[3], v[4])))}


def test_signatures_of_linked_sets_meet():
    rng = np.random.default_rng(4)
    for size in (50, 70, 90, 160, 290, 500, 900, 3000):
        for _ in range(12):
            s = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
            k = int(rng.integers(0, len(s) // 4 + 1))
            t = np.unique(np.concatenate([s[k:], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + len(s) // 12))).astype(np.uint64)]))
            both = len(np.intersect1d(s, t))
            if 100 * both < 75 * (len(s) + len(t) - both):
                continue
            who, sig, _ = ngram_join._signatures(np.concatenate([s, t]), np.array([0, len(s), len(s) + len(t)]))
            assert np.intersect1d(sig[who == 0], sig[who == 1]).size
            assert min(x.min() for x in ngram_join.spares(s, np.array([0, len(s)]))) >= 0
