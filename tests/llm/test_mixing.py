from collections import Counter, defaultdict

from lectern.llm import mixing
from tests.llm.fixtures import DOCS, awkward_docs, prose


def shares(sizes):
    """Targets by sharing out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        free -= over
    return target


def corpus():
    rows = []
    for i in range(300):
        source = ["a", "b", "é", "c", "z", None][i % 6] if i % 3 else "hot"
        n = 5000 if i == 7 else i % 40
        rows.append((i, prose(i, n) if n else (None if i % 2 else ""), "en", source, 0))
    return rows


def test_targets_and_taken_words(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    sizes, longest = Counter(), defaultdict(int)
    for _, t, _, s, _ in rows:
        n = len((t or "").split())
        sizes[s] += n
        longest[s] = max(longest[s], n)
    want, taken = shares(sizes), Counter()
    for r in mixing.plan(docs).collect():
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1 for s in want)
    again = {(r.doc_id, r.taken) for r in mixing.plan(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in mixing.plan(docs).collect()}


def test_mix_repeats_rows(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.plan(docs).collect() if r.taken}
    out = mixing.mix(docs)
    assert out.columns == docs.columns and Counter(r.doc_id for r in out.collect()) == taken


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    assert mixing.plan(docs).count() == docs.count()
    assert mixing.plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    silent = docs.where("text is null or text = ''")
    assert {r.taken for r in mixing.plan(silent).collect()} == {0}
