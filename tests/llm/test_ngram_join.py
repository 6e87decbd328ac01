import random

import pyarrow as pa
import pytest

from lectern.llm import components as contraction
from lectern.llm import ngram_join as nj
from lectern.llm.components import components
from tests.llm.fixtures import DOCS, VOCABULARY, awkward_docs, prose, rows


def shingles(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(table):
    sets = [(d, shingles(t)) for d, t, *_ in table]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d if d is not None else -1, len(s), (least.get(root(i), -1) if s else d if d is not None else -1)) for i, (d, s) in enumerate(sets))


def edited(text, rng, n):
    w = text.split(" ")
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(w))
        if kind == 0:
            w[at] = rng.choice(VOCABULARY)
        elif kind == 1:
            del w[at]
            w = w or ["x"]
        else:
            w.insert(at, rng.choice(VOCABULARY))
    return " ".join(w)


@pytest.mark.parametrize("seed,small,block", [(1, 8, 2048), (2, 3, 7)])
def test_equals_brute_force(spark, monkeypatch, seed, small, block):
    monkeypatch.setattr(nj, "SMALL", small)
    monkeypatch.setattr(nj, "BLOCK", block)
    rng = random.Random(seed)
    texts = []
    for i, n in enumerate([3, 5, 6, 9, 20, 40, 70, 90, 150, 260, 400, 700, 1500]):
        base = prose(seed * 1000 + i, n)
        for _ in range(25):
            texts.append(edited(base, rng, rng.randrange(0, max(1, n // 18) + 2)))
    base = prose(77, 120)
    texts += [edited(base, rng, 2) for _ in range(60)]  # a large group of near copies
    line = prose(78, 30)
    texts += [prose(5000 + i, 60) + " " + line for i in range(60)]  # one line that many share
    texts += [texts[3]] * 5
    rng.shuffle(texts)
    table = rows(texts)
    got = nj.join(spark.createDataFrame(table, DOCS).repartition(6)).collect()
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == brute(table)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    got = sorted(tuple(-1 if x is None else x for x in r) for r in nj.join(docs).collect())
    assert got == brute([tuple(r) for r in docs.collect()])
    assert nj.join(docs.limit(0)).count() == 0
    kept = nj.one_of_each(docs)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("held", [1 << 20, 16])
def test_components_of_chain_and_star(spark, monkeypatch, held):
    monkeypatch.setattr(contraction, "TASK_LINKS", held)  # the second: many tasks, so that rounds follow
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(2000, 2001)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(40)}, 2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_component_whatever_its_id(spark):
    a, b, c, d = (prose(i, 60) for i in range(4))
    data = [(None, a), (None, a), (None, a + " end"), (None, b), (3, b), (2, b + " end"), (5, c), (5, d), (5, d), (9, c + " end"), (None, ""), (None, None), (6, " "), (6, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in data], DOCS).repartition(4)
    kept = sorted(((r.doc_id, r.text) for r in nj.one_of_each(docs).collect()), key=str)
    group = [x for x in kept if x[1] and x[1].startswith(a)]
    assert len(group) == 1 and group[0][0] is None
    rest = sorted([(2, b + " end"), (5, c), (5, d), (None, ""), (None, None), (6, " ")], key=str)
    assert [x for x in kept if x not in group] == rest


def test_overlapping_groups_are_compared_as_one(spark, monkeypatch):
    """A cluster's members meet in many groups; each member is sent about once and not once for each group."""
    sent, hidden = [], nj._hidden

    def counted(told, known, whole):
        sent.append((told.count(), told.select("v").distinct().count()))
        return hidden(told, known, whole)

    monkeypatch.setattr(nj, "_hidden", counted)
    rng = random.Random(5)
    base = prose(91, 150)
    texts = [edited(base, rng, rng.choice([1, 2, 8])) for _ in range(150)]
    table = rows(texts)
    got = nj.join(spark.createDataFrame(table, DOCS).repartition(4)).collect()
    assert sorted(tuple(r) for r in got) == brute(table)
    assert sent and all(n <= 3 * v for n, v in sent), sent


@pytest.mark.parametrize("others", [5, 20, 133])
def test_blocks_of_one_root_do_not_meet(spark, monkeypatch, others):
    def cells(whole):
        def run(batches):
            for b in batches:
                names = ["gid", "a", "b", "worth"]
                at = [x * 1000 + y for x, y in zip(b.column("lo").to_pylist(), b.column("hi").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("gid"), b.column("v"), pa.array(at, pa.int64()), b.column("side").cast(pa.float64())], names)

        return run

    monkeypatch.setattr(nj, "BLOCK", 7)
    monkeypatch.setattr(nj, "_compared", cells)
    n = 140
    root = {v: 0 if v < n - others else v for v in range(n)}
    told = spark.createDataFrame([(1, v, r) for v, r in root.items()], "gid long, v long, root long")
    known = spark.createDataFrame([(v, 100, b"") for v in root], "v long, n_shingles long, sketch binary")
    met = {}
    for r in nj._hidden(told, known, False).collect():
        met.setdefault(r.b, []).append((r.a, r.worth))
    pairs = [(x, y) for c in met.values() for x, s in c for y, t in c if x < y and root[x] != root[y] and (s != t or s == 2)]
    assert sorted(pairs) == [(x, y) for x in range(n) for y in range(x + 1, n) if root[x] != root[y]]
    if others < n // 4:
        assert sum(map(len, met.values())) < n * n // 7 // 2
