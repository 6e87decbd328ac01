from collections import Counter
from itertools import permutations

from lectern.llm import filter_audit as fa
from tests.llm.fixtures import DOCS, awkward_docs, prose

LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    """The metrics by walking every document through every order."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))

    def failures(i, t):
        t = t or ""
        words = [w for w in t.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
        out = set()
        out |= {"A"} if len(words) < 200 else set()
        out |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else set()
        out |= {"D"} if set(t) & set("#$%&*|") else set()
        return out | ({"E"} if i is not None and least[t] < i else set())

    rows, total = {}, Counter()
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], failures(d[0], d[1])) for d in docs if (d[2] or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[part, f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                ]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def told(out):
    return {(r["part"], r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in out.collect()}


def corpus():
    texts = [prose(k, 230) for k in range(8)] + ["A B C", "a | b", "same " * 300, "", None, prose(3, 230), prose(3, 230) + " #", "SHOUT " * 210]
    docs = [(i, texts[i % len(texts)], ["en", None, "", "fr"][i % 4 if i % 3 else 0], "s", 0) for i in range(60)]
    docs += [(None, texts[0], "en", "s", 0), (None, None, "fr", "s", 0), (5, texts[5], "en", "s", 0), (5, texts[6], "fr", "s", 0)]
    labels = [(i, i % 2, (i // 3) % 2) for i in range(0, 60, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    return docs, labels


def test_metrics_equal_walking_every_document(spark):
    docs, labels = corpus()
    df, said = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    assert told(fa.audit(df, said)) == plain(docs, labels)


def test_large_labels_are_joined_by_shuffle(spark, monkeypatch):
    docs, labels = corpus()
    monkeypatch.setattr("lectern.llm.common.BROADCAST_BYTES", 0)
    assert told(fa.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))) == plain(docs, labels)


def test_hot_copies_and_other_filters(spark):
    docs = [(i, "hot text" if i % 3 else f"w{i}", "en", "s", 0) for i in range(300)]
    filters = lambda t: {"X": t.contains("hot"), "Y": t.endswith("7")}
    out = told(fa.audit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame([], LABELS), filters=filters))
    assert len(out) == 18 and out["en", "XYE", 1][:2] == (100, 200) and out["en", "EXY", 1][:2] == (101, 199) and out["en", "EXY", 2][:3] == (100, 1, 199)


def test_awkward_rows(spark):
    docs, none = awkward_docs(spark), spark.createDataFrame([], LABELS)
    out = fa.audit(docs.selectExpr("*", "1 AS mask", "2 AS part", "3 AS n", "4 AS text_key", "5 AS step", "6 AS good"), none)
    assert told(out) == plain([tuple(r) for r in docs.collect()], [])
    assert fa.audit(docs.limit(0), none).count() == 0 and fa.audit(docs.limit(0), none).columns == out.columns
