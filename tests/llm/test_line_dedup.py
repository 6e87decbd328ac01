import random
import re

from lectern.llm import line_dedup as ld
from tests.llm.fixtures import DOCS, VOCABULARY, awkward_docs, prose, rows
from tests.llm.test_ngram_join import edited


def brute(table):
    out, seen = {}, []
    for doc, text, *_ in sorted(table, key=lambda r: r[0]):
        for i, line in enumerate((text or "").split("\n")):
            w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line))
            if not w:
                continue
            if w in (x for _, x in seen):
                out[doc, i] = False
            elif any(min(len(w), len(x)) >= ld.LEAST and ld.one_edit(w, x) for _, x in seen):
                out[doc, i] = True
            seen.append(((doc, i), w))
    return out


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ld, "FLUSH", 60)
    rng = random.Random(4)
    bases = [prose(i, rng.choice([3, 7, 8, 9, 10, 12, 20, 35])) for i in range(25)]
    texts = []
    for i in range(70):
        lines = [prose(100 + i, 12)]
        for _ in range(rng.randrange(0, 6)):
            b = rng.choice(bases)
            lines.append(rng.choice([b, edited(b, rng, 1), edited(b, rng, 1), edited(b, rng, 2), b.upper(), "", rng.choice(VOCABULARY)]))
        texts.append("\n".join(lines))
    table = rows(texts)
    got = {(r.doc, r.line): r.near for r in ld.removed(spark.createDataFrame(table, DOCS).repartition(5)).collect()}
    want = brute(table)
    assert sum(want.values()) > 10 and got == want


def test_text_and_counts(spark):
    a = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(rows([f"{a}\n\nother", f"start\n{a.upper()}\n{a} tail\nOther", None]), DOCS)
    out = {r.doc_id: r for r in ld.dedup(docs).collect()}
    assert out[0].text == f"{a}\n\nother" and out[1].text == "start" and (out[1]["__exact"], out[1]["__near"]) == (2, 1) and out[2].text is None


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    out = ld.dedup(docs)
    assert out.count() == docs.count() and out.columns[:5] == docs.columns
    assert ld.dedup(docs.limit(0)).count() == 0
    assert ld.without_repeated_lines(docs).columns == docs.columns


def test_rows_that_share_an_id_are_cut_one_by_one(spark):
    """Rows of one doc_id, or of none, with different texts: of every line one copy stays, and nothing else goes."""
    long = "one two three four five six seven eight nine"
    for doc in (None, 7):
        texts = ["aaa\nbbb", "ccc\naaa", "aaa\nddd", f"x\n{long}", f"{long} ten\ny", "aaa\nddd"]
        out = ld.dedup(spark.createDataFrame([(doc, t, "en", "s", len(t)) for t in texts], DOCS).repartition(3)).collect()
        assert len(out) == len(texts)
        left = [line for t in {r.text for r in out} for line in t.split("\n") if line]
        near = {long, f"{long} ten"}
        assert sorted(x for x in left if x not in near) == ["aaa", "bbb", "ccc", "ddd", "x", "y"] and len(near & set(left)) == 1
