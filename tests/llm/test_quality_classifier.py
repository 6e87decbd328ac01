import random

import numpy as np

from lectern.llm import quality_classifier as qc
from tests.llm.fixtures import DOCS, awkward_docs, prose

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good, text = rng.random() < 0.7, prose(seed * 10_000 + i, rng.randrange(15, 200))
        if not good:
            text = rng.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: " ".join(w + "###" for w in t.split()), lambda t: " ".join(w for w in t.split()[:20] for _ in range(7)), lambda t: t.replace(" ", " | ")])(text)
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_accuracy_on_held_out_rows(spark):
    docs, labels = corpus(600, 1)
    out = qc.classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    truth = {d: q for d, q, _ in labels}
    held = [r for r in out if r.held_out]
    assert len(out) == 600 and 100 < len(held) < 300
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_held_out_labels_are_not_used(spark):
    docs, labels = corpus(90, 2)
    d = spark.createDataFrame(docs, DOCS)
    held = {r.doc_id for r in d.where(qc.held_out(d.doc_id)).collect()}
    lied = [(i, 1 - q if i in held else q, t) for i, q, t in labels]
    a, b = ({r.doc_id: round(r.score, 6) for r in qc.classify(d, spark.createDataFrame(x, LABELS)).collect()} for x in (labels, lied))
    assert a == b


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    none = spark.createDataFrame([], LABELS)
    out = qc.classify(docs, none).collect()
    assert len(out) == docs.count() and {r.score for r in out} == {0.5}
    odd = spark.createDataFrame([(3, None, 0), (None, 1, 0), (4, 1, 0), (4, 0, 1), (8, 0, 0)], LABELS)
    assert qc.classify(docs, odd).count() == docs.count()
    assert qc.classify(docs.limit(0), odd).count() == 0
