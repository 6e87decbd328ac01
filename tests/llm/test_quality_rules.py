import random
import re

from lectern.llm import quality_rules as qr
from tests.llm.fixtures import DOCS, awkward_docs, prose, rows


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    twice = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice)


def test_counts_equal_brute_force(spark):
    rng = random.Random(6)
    texts = []
    for i in range(60):
        parts = [prose(rng.randrange(12), rng.randrange(4, 25)) for _ in range(rng.randrange(1, 8))]
        texts.append(rng.choice(["\n", " ", " \x0b\t"]).join(parts) + rng.choice(["", " ### <b>", " a" * 30]))
    docs = awkward_docs(spark, texts)
    told = {r.doc_id: r.text for r in docs.collect()}
    got = qr.figures(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        want = brute(told[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)


def test_lines_and_documents(spark):
    good = prose(1, 40)
    menu = "Home\nLogin\nSearch | News | About | More\nAll rights reserved.\n"
    texts = [good, menu + good, prose(2, 30).upper().replace(" ", "!! "), good.replace(" ", "### "), menu * 9 + prose(3, 22)]
    docs = spark.createDataFrame(rows(texts), DOCS)
    assert {r.doc_id: r.kept for r in qr.figures(docs).collect()} == {0: True, 1: True, 2: False, 3: False, 4: False}
    out = {r.doc_id: r for r in qr.apply_rules(docs).collect()}
    assert set(out) == {0, 1} and out[1].text == good and out[1].n_chars == len(good)
    plan = qr.figures(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    assert qr.figures(docs.limit(0)).count() == 0 and qr.apply_rules(docs.withColumn("w", docs.doc_id).withColumn("kept", docs.doc_id)).columns[-1] == "kept"
