import random
import re

import pytest

from lectern.llm import sentence_spans as ss
from tests.llm.fixtures import DOCS, awkward_docs, prose, rows


def brute(table):
    """doc_id -> numbers of removed sentences, by comparing all runs in order."""
    sents = {}
    for doc, text, *_ in table:
        text, out = re.sub("[A-Z]", lambda m: m[0].lower(), text or ""), []
        for line in text.split("\n"):
            now = []
            for w in re.findall(r"[^\x20\x09-\x0D]+", line):
                now.append(w)
                if w[-1] in ".!?:;":
                    out.append(now)
                    now = []
            if now:
                out.append(now)
        sents[doc] = out
    seen, gone = {}, {}
    for doc in sorted(sents):
        n, runs = len(sents[doc]), set()
        size = lambda a, b: sum(map(len, sents[doc][a:b]))
        for i in range(n):
            runs |= {(i, j) for j in range(i + ss.RUN, n + 1) if size(i, j) >= ss.LEAST and (j == i + ss.RUN or size(i, j - 1) < ss.LEAST)}
            runs |= {(j, i + 1) for j in range(i + 2 - ss.RUN) if size(j, i + 1) >= ss.LEAST and (j == i + 1 - ss.RUN or size(j + 1, i + 1) < ss.LEAST)}
            if size(i, i + 1) >= ss.LONG:
                runs.add((i, i + 1))
        for a, b in sorted(runs):
            words = [w for s in sents[doc][a:b] for w in s]
            if seen.setdefault(tuple(words), (doc, a)) != (doc, a):
                gone.setdefault(doc, set()).update(range(a, b))
    return {d: sorted(g) for d, g in gone.items()}


@pytest.mark.parametrize("flush", [1 << 21, 50])
def test_equals_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(ss, "FLUSH", flush)
    rng = random.Random(3)
    shared = [prose(100 + i, 60, 7) for i in range(6)]
    texts = []
    for i in range(80):
        parts = [prose(i, rng.randrange(0, 80)), *rng.sample(shared, rng.randrange(0, 3)), prose(1000 + i, rng.randrange(0, 40))]
        texts.append(rng.choice(["\n", " "]).join(parts))
    table = rows([*texts, " ".join(["long"] * 50), "Long " + " ".join(["long"] * 49)])
    docs = spark.createDataFrame(table, DOCS).repartition(5)
    got = {r.doc: r.gone for r in ss.removed(docs).collect()}
    want = brute(table)
    assert want and got == want


def test_text_keeps_first_and_loses_later(spark):
    passage = prose(7, 60, 8)
    docs = spark.createDataFrame(rows([f"First one here. {passage} End of it.", f"Another start.\n{passage}\nAnd its end."]), DOCS)
    out = {r.doc_id: r for r in ss.dedup(docs).collect()}
    assert out[0].text == f"First one here. {passage} End of it." and out[0]["__n_removed"] == 0
    assert out[1]["__n_removed"] >= 7 and "Another start." in out[1].text and "its end" in out[1].text


def repeated(table, span=50):
    """doc_id -> places of the words in stretches of span words that also stand earlier."""
    seen, gone = {}, {}
    for doc, text, *_ in sorted(table, key=lambda r: r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        for at in range(len(w) - span + 1):
            if seen.setdefault(tuple(w[at : at + span]), (doc, at)) != (doc, at):
                gone.setdefault(doc, set()).update(range(at, at + span))
    return gone


@pytest.mark.parametrize("flush", [1 << 21, 50])
def test_passages_of_few_or_cut_sentences(spark, monkeypatch, flush):
    monkeypatch.setattr(ss, "FLUSH", flush)
    rng = random.Random(8)
    planted = [prose(900, 51, 51), prose(901, 51, 26), prose(902, 70, 36), prose(903, 51, 20), prose(904, 130, 200)]
    texts = [f"{prose(i, 30, 100)} {rng.choice(planted)} {prose(1000 + i, 30, 100)}" for i in range(40)]
    texts += [f"{prose(i, 31, 8)} {prose(902, 70, 36).rsplit(' ', 20)[0]}\n{prose(2000 + i, 12)}" for i in range(40, 45)]
    texts += [f"{prose(905, 49, 100)} {prose(3000 + i, 30, 100)}" for i in range(2)]
    texts += ["same " * 130, prose(906, 60, 100) + " " + prose(906, 60, 100)]
    table = rows(texts)
    docs = spark.createDataFrame(table, DOCS).repartition(5)
    got = {r.doc: {w for x in r.cut for w in range(x.a, x.b)} for r in ss.passages(docs).collect()}
    want = repeated(table)
    assert len(want) > 35 and got == want
    out = {r.doc_id: r for r in ss.dedup(docs).collect()}
    for doc, gone in want.items():
        assert out[doc]["__n_removed"] > 0
        left = [w for i, w in enumerate(texts[doc].split()) if i not in gone]
        assert out[doc].text.split() == left
    assert all(out[d].text == texts[d] for d in range(len(texts)) if d not in want)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    out = ss.dedup(docs)
    assert out.count() == docs.count() and out.columns[:5] == docs.columns
    same = {(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 8}
    assert same <= {(r.doc_id, r.text) for r in out.collect()}
    assert ss.dedup(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_cut_one_by_one(spark):
    passage, long = prose(7, 60, 8), prose(8, 60, 100)
    for doc in (None, 7):
        texts = [f"First begins.\n{passage}", f"Other one.\n{passage}", f"here {long}", f"there is {long}", f"there is {long}"]
        out = ss.dedup(spark.createDataFrame([(doc, t, "en", "s", len(t)) for t in texts], DOCS).repartition(3)).collect()
        left = {r.text.strip() for r in out}
        assert len(out) == 5 and len(left) == 4
        for whole, heads in ((passage, ("First begins.", "Other one.")), (long, ("here", "there is"))):
            mine = sorted(t for t in left if t.startswith(heads))
            assert sum(whole in t for t in mine) == 1 and sum(t in heads for t in mine) == 1


def test_short_runs_stay_and_two_long_sentences_go(spark):
    short = "It is so. We agree on that. Thank you all very much."
    two = prose(31, 28, 28) + " " + prose(32, 30, 30)
    texts = [f"{prose(50 + i, 40)} {short} {prose(60 + i, 20)} {two if i % 2 else ''} {prose(70 + i, 9)}" for i in range(6)]
    out = {r.doc_id: r for r in ss.dedup(spark.createDataFrame(rows(texts), DOCS)).collect()}
    assert {d for d, r in out.items() if r["__n_removed"]} == {3, 5} and all(short in r.text for r in out.values())
    assert two in out[1].text and all(two not in out[d].text for d in (3, 5))
