import random
import tracemalloc

import numpy as np

from lectern.llm import language_id as li
from tests.llm.fixtures import DOCS, awkward_docs

WORDS = {"en": "the and ing tion of that with was her", "de": "der und keit ung schaft nicht ein über", "fr": "le la eau ment pour avec été une", "es": "el los ción que año para más dos"}


def text(lang, rng, n):
    return " ".join("".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randrange(1, 3))) for _ in range(n))


def test_accuracy_on_held_out_rows(spark):
    rng = random.Random(2)
    data = [(i, text(lang := rng.choice(list(WORDS)), rng, rng.randrange(3, 400)), lang, "s", 0) for i in range(400)]
    docs = spark.createDataFrame(data, DOCS)
    truth = {r[0]: r[2] for r in data}
    out = li.identify(docs).collect()
    assert {r.doc_id: r.held_out for r in out} == {i: li.held_out_by_crc(i, 4) == 2 for i in truth}
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_labels_of_held_out_rows_are_not_used(spark):
    rng = random.Random(3)
    data = [(i, text(lang := rng.choice(["en", "de"]), rng, 40), lang, "s", 0) for i in range(120)]
    lied = [(i, t, "fr" if li.held_out_by_crc(i, 4) == 2 else lang, s, n) for i, t, lang, s, n in data]
    a, b = (sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in li.identify(spark.createDataFrame(x, DOCS)).collect()) for x in (data, lied))
    assert a == b


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    out = li.identify(docs).collect()
    assert len(out) == docs.count()
    assert {r.lang_pred for r in out if r.doc_id in (0, 1, 2, 6)} == {"und"} and {r.lang_pred for r in out if r.doc_id == 8} == {"en"}
    assert li.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in li.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).na.replace("", None, "lang")).collect()} == {"und"}


def held(run):
    """What run returns, and the MB it held at most beside what was there before."""
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_follows_neither_the_sample_nor_a_text(monkeypatch):
    rng = random.Random(4)
    labels = [rng.choice(list(WORDS)) for _ in range(600)]
    bodies = [(text(lang, rng, 500) + " É Ü ").encode() for lang in labels]
    texts = [li.windows(b * 4, li.WINDOWS) for b in bodies]
    assert sum(map(len, texts)) == 4800
    model, fitting = held(lambda: li.Model.fit(texts, labels))
    long = b" ".join(bodies)
    (best, score), scoring = held(lambda: model.score([bodies[0], long, b"x", bodies[1]]))
    assert fitting < 100 and scoring < 100
    # slices change nothing, also where a window ends within a letter
    monkeypatch.setattr(li, "AT_ONCE", 1 << 30)
    whole = li.Model.fit(texts, labels)
    assert np.array_equal(model.landmarks, whole.landmarks)
    again, close = whole.score([bodies[0], long, b"x", bodies[1]])
    assert best.tolist() == again.tolist() and np.allclose(score, close, atol=1e-4)
    cut = [b"ab\xc3", b"\x89cd"]
    rows = list(li.features(cut))
    monkeypatch.setattr(li, "AT_ONCE", 1)
    assert np.array_equal(np.concatenate(rows), np.concatenate(list(li.features(cut))))
