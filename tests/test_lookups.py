"""Joins by likeness and by content against all pairs, and rows whose rule was wrong before."""

import random

from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.operators import lifecycle as L
from lectern.operators import sequences as S


def people(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abdeiklmnorst") for _ in range(rng.randint(2, 6))).title()
    return [f"{word()} {word()}" for _ in range(n)]


def worn(name, rng):
    k = rng.randrange(6)
    at = rng.randrange(len(name))
    return [name, name[:at] + name[at + 1 :], name[:at] + "x" + name[at:], " ".join(reversed(name.split())), name.upper(), name[:at] + "qq" + name[at + 2 :]][k]


def test_no_pair_over_the_threshold_is_lost(spark):
    rng = random.Random(1)
    members = sorted(set(people(60, 2)))
    names = sorted({" ".join(worn(rng.choice(members), rng).split()) for _ in range(120)} | set(people(20, 3)) | {"Xatherine", "zz"})
    members.append("Katherine")
    frames = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(m,) for m in members], "member string")
    pairs = {tuple(r) for r in S.similar_candidates(*frames, 0.7).collect()}
    ratio = {(n, m): S.similarity(n.lower(), m.lower()) for n in names for m in members}
    assert {p for p, r in ratio.items() if r > 70} <= pairs and len(pairs) < len(ratio) / 2
    got = {r.name: (r.member, r.confidence, r.method) for r in S.resolved_names(*frames).collect()}
    for n in names:
        same = [m for m in members if m.lower() == n.lower()]
        best = max(members, key=lambda m: (round(ratio[n, m]), [-ord(c) for c in m] + [1]))
        score = round(ratio[n, best])
        want = (min(same), 1.0, "exact") if same else (best, score / 100, "fuzzy") if score > 80 else (None, 0.0, "none")
        assert got[n] == want, n
    assert got["Xatherine"][0] == "Katherine"


def test_names_of_common_letters_meet_few_members(spark):
    """Names drawn from sixteen letters, all of them common, of any length, long ones too: no close pair is lost, few others meet."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("aeioubcdfglmnrst") for _ in range(n)).title()
    members = sorted({f"{word(6)} {word(8)}" for _ in range(150)} | {f"{word(rng.randint(1, 9))} {word(rng.randint(1, 12))}" for _ in range(60)} | {f"{word(18)} {word(n)}" for n in range(14, 34)} | {"Ab", "Ёлка Ñandú"})

    def spoilt(name):
        for _ in range(max(1, len(name) // 7)):
            at = rng.randrange(len(name))
            name = [name[:at] + name[at + 1 :], name[:at] + rng.choice("xae") + name[at:], name[:at] + "o" + name[at + 1 :]][rng.randrange(3)]
        return " ".join(name.split())

    names = sorted({n for m in members for n in (spoilt(m), spoilt(" ".join(reversed(m.split())))) if n})
    frames = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(m,) for m in members], "member string")
    pairs = {tuple(r) for r in S.similar_candidates(*frames, 0.805).collect()}
    assert {(n, m) for n in names for m in members if S.similarity(n.lower(), m.lower()) >= 80.5} <= pairs
    assert len(pairs) < 2 * len(names)


def test_names_of_the_same_letters_are_no_candidates(spark):
    """Anagrams share all letters, rare ones too; only those with a long common subsequence may meet."""
    rng = random.Random(7)
    names = sorted({"".join(rng.sample("aeioubcdfglmnrs", 15)) for _ in range(200)})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    pairs = {tuple(r) for r in S.similar_candidates(df, df.withColumnRenamed("name", "member"), 0.805).collect()}
    assert {(n, n) for n in names} <= pairs and len(pairs) < 2 * len(names)


def test_awkward_names(spark):
    names = spark.createDataFrame([(None,), ("",), ("  ann   lee ",), ("Ann Lee",)], "name string")
    members = spark.createDataFrame([("Ann Lee",), (None,), ("",)], "member string")
    out = {r.name: r.method for r in S.resolved_names(names, members).collect()}
    assert out["ann lee"] == out["Ann Lee"] == "exact" and out[None] == "none"
    assert S.resolved_names(names.limit(0), members).count() == 0
    assert {r.method for r in S.resolved_names(names.where("name = 'Ann Lee'"), members.limit(0)).collect()} == {"none"}


def test_needles_of_any_length(spark):
    texts = ["Jo Al", "Bo", "r#0001", "r#0002", "r#0012", "", None, "Straße", "AbAb"]
    needles = ["al", "bo", "r#0", "r#0002", "x", "", None, "o", "ß", "#00", "abab", "R#0001 too long"]
    left = spark.createDataFrame(list(enumerate(texts)), "id long, name string")
    right = spark.createDataFrame([(100 + i, n) for i, n in enumerate(needles)], "nid long, needle string")
    got = sorted((r.id, r.nid) for r in L.contains_join(left, "name", right, "needle").collect())
    assert got == sorted((i, 100 + k) for i, t in enumerate(texts) for k, n in enumerate(needles) if t is not None and n is not None and n.lower() in t.lower())
    assert L.contains_join(left, "name", right.limit(0), "needle").count() == 0 and L.contains_join(left.limit(0), "name", right, "needle").count() == 0


def test_needles_do_not_share_the_piece_that_all_texts_hold(spark):
    left = spark.range(200).select("id", F.format_string("member#%04d", "id").alias("name"))
    right = spark.range(100).select(F.col("id").alias("nid"), F.format_string("er#%04d", F.col("id") * 2).alias("needle"))
    out = L.contains_join(left, "name", right, "needle")
    assert sorted((r.id, r.nid * 2) for r in out.collect()) == [(2 * k, 2 * k) for k in range(100)]


def test_the_latest_light_errors_are_taken_before_the_filter(spark):
    rows = [(i, i, "low", "linear_backoff" if i < 15 else "manual_intervention", 0, False, "rate_limit" if i % 2 else "network") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, at long, severity string, strategy string, retries int, resolved boolean, category string")
    assert sorted((r.id, r.outcome) for r in L.background_recovery(df).collect()) == [(i, "resolved" if i % 2 else "retry") for i in range(10, 15)]


def test_the_last_value_of_a_property_counts(spark):
    rows = [("u", "http://a/x#title", "first", 1), ("u", "http://b/title", "last", 3), ("u", "http://a/x#title", "second", 2), ("u", "http://a#b/date", "no", 4), ("w", "http://a/date", "d", 5)]
    df = spark.createDataFrame(rows, "s string, p string, o string, k long")
    assert {tuple(r) for r in L.property_pivot(df, "s", "p", "o", ["title", "date"], "k").collect()} == {("u", "last", None), ("w", None, "d")}


def test_six_words_of_a_report():
    assert R.REPORT_WORDS == ["plenary", "sitting", "president", "debate", "parliament", "agenda"]
