import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lectern.llm import packing as pk
from tests.llm.fixtures import DOCS, awkward_docs, prose, rows


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["", " ", "  a  b ", "it's we'll don't 'sup", "a\n\n b\t\tc \n", "naïve café ünïcode", "数字１２３ и кириллица", "🙂🙂 emoji‍", "x" * 300, "1234567 12.5%", "<|endoftext|> told", "a <|endoftext|><|endoftext|>\n\n b <|endoftext|", "  <|endoftext|>  ", "\x00\x01 \x85  z", "é ﻿"]

ODD += ["a" + " " * 3000 + "b" + "\n" * 2000, "ab" * 40000]


def test_ids_equal_the_library(monkeypatch):
    encode, t = pk.Encoder(*pk.default_tokenizer()), tokenizer()
    texts = ODD + [prose(1, 300), " ".join(ODD)]
    want = [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert [encode(x) for x in texts] == want
    monkeypatch.setattr(pk, "BLOCK", 7)
    assert [encode(x) for x in texts] == want


def test_packing_is_whole_gapless_and_no_worse_than_best_fit(spark, monkeypatch):
    monkeypatch.setattr(pk, "GROUP", 150)
    texts = [prose(i, 30 + i * 13 % 900) for i in range(300)] + [prose(999, 4000)] + ODD
    docs = spark.createDataFrame(rows(texts), DOCS)
    got = pk.pack(docs).collect()
    t, by_doc, by_seq = tokenizer(), defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert len(by_doc) == len(texts)
    for d, parts in by_doc.items():
        ids = np.array(t.encode(texts[d], add_special_tokens=False).ids + [0], "<u4")
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert len(parts) == 1 or all(r.length == 2048 for r in parts[1:])
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    least = -(-sum(r.length for r in got) // 2048)
    assert least <= len(by_seq) <= least * 1.05 + 3


def test_evolution_beats_its_seed():
    size = np.random.default_rng(5).integers(300, 1200, 600)
    seed = pk.best_fit(np.argsort(-size, kind="stable"), size, 2048)
    best = pk.evolve(size, 2048, [], 1, 300)[0]
    assert np.bincount(best, size).max() <= 2048 and len(best) == 600
    assert pk.fitness(best, size, 2048) >= pk.fitness(seed, size, 2048) and len(set(best)) < len(set(seed))


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    out = pk.pack(docs).collect()
    assert len({(r.doc_id, r.sequence_id, r.offset) for r in out}) == len(out) >= docs.count()
    assert pk.pack(docs.limit(0)).count() == 0
