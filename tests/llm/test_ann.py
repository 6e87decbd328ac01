import numpy as np

from lectern.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, count):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != ids[q]][:count]
        out[int(ids[q])] = [(int(ids[k]), float(d[k])) for k in order]
    return out


def run(spark, rows, every=10):
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, SCHEMA), every).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in got.items()}


def recall(got, want):
    return np.mean([len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) / len(w) for q, w in want.items()])


def test_recall_without_and_with_structure(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 700)
    rng = np.random.default_rng(1)
    flat = rng.normal(size=(2000, 32))
    centre = rng.normal(size=(40, 32))
    close = centre[rng.integers(0, 40, 2000)] + 0.1 * rng.normal(size=(2000, 32))
    for x in (flat, close):
        rows = [(i, [float(np.float32(v)) for v in r], 0) for i, r in enumerate(x)]
        want, got = brute(rows, 50, 10), run(spark, rows, 50)
        assert set(got) == set(want) and all(len(v) == 10 for v in got.values()) and recall(got, want) >= 0.9
        for q, found in got.items():
            assert found == sorted(found, key=lambda p: (p[1], p[0]))
            for v, s in found:
                assert abs(s - np.linalg.norm(np.float32(x[q]).astype(float) - np.float32(x[v]).astype(float))) < 1e-12


def test_awkward_rows(spark):
    base = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, base, 0) for i in range(30)] + [(100, [2.0, 2.0, 3.0, 4.0], 0), (101, [9.0, 9.0, 9.0, 9.0], 1)]
    bad = [(200, None, 0), (210, [0.0] * 4, 0), (220, [1.0, None, 2.0, 3.0], 0), (230, [float("nan")] * 4, 0), (240, [float("inf"), 1.0, 1.0, 1.0], 0), (250, [1.0], 0), (None, base, 0), (5, base, 0)]
    assert run(spark, rows + bad) == brute(rows, 10, 10)
    assert run(spark, [(0, base, 0), (10, [1.0, 2.0, 3.0, 5.0], 0)]) == {0: [(10, 1.0)], 10: [(0, 1.0)]}
    assert run(spark, []) == {} and run(spark, bad[:5]) == {}
