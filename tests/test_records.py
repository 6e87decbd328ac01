"""Rules on records, by hand."""

import re
from datetime import date

from pyspark.sql import functions as F

from lectern.operators import lifecycle as L
from lectern.operators import quality as Q
from lectern.operators import records as X
from lectern.plans.layers import applied


def over(spark, values, rule, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"k long, v {kind}")
    return [r.x for r in sorted(df.select("k", rule(F.col("v")).alias("x")).collect())]


def test_minutes_dates_and_iso_times(spark):
    got = over(spark, ["word " * 300, "word " * 299 + "(Applause)", "question " * 150, "", None, "one two", "Mr President laughter " * 50], X.speaking_minutes)
    assert [round(x, 6) for x in got] == [2.0, 2.4, 1.1, 0.0, 0.0, 0.5, 1.32]
    day = date(2024, 1, 15)
    assert over(spark, ["2024-01-15", " 15/1/2024", "15.01.2024", "15 January 2024", "january 15, 2024", "20240115", "2024-02-30", None, ""], X.written_date) == [day] * 5 + [None] * 4
    good = ["2024-01-15", "2024-01-15T10:30Z", "2024-01-15T10:30:59.5+02:00", "2024-02-29 23"]
    bad = ["2023-02-29", "2024-01-15T24:00", "2024-01-15T10:60", "2024-01-15T10:30:61", "2024-01-15T10:30+24:00", "2024-1-5", "15.01.2024", "", None, "2024-01-15T", "x2024-01-15"]
    assert over(spark, good + bad, X.is_iso) == [True] * len(good) + [False] * len(bad)


def test_date_ranges(spark):
    d = date
    df = spark.createDataFrame([(1, d(2024, 1, 1), d(2024, 1, 20), 4), (2, d(2024, 1, 1), d(2024, 1, 9), 20), (3, d(2024, 1, 2), d(2024, 1, 2), 20), (4, d(2024, 1, 1), d(2024, 1, 17), 1), (5, None, d(2024, 1, 17), 1)], "k long, a date, z date, size int")
    got = sorted((r.k, r.first, r["last"]) for r in X.date_ranges(df, "a", "z", "size").select("k", "first", "last").collect())
    # the third range of the fourth would begin on the day of the end, which is not before it
    assert got == [(1, d(2024, 1, 1), d(2024, 1, 8)), (1, d(2024, 1, 9), d(2024, 1, 16)), (1, d(2024, 1, 17), d(2024, 1, 20)), (2, d(2024, 1, 1), d(2024, 1, 9)), (4, d(2024, 1, 1), d(2024, 1, 8)), (4, d(2024, 1, 9), d(2024, 1, 16))]


def test_orders_maps_and_spreads(spark):
    rows = [("a", 1, 1), ("a", 2, 2), ("b", 1, 2), ("b", 2, 1), ("c", 1, 5), ("d", 1, 1), ("d", 2, 1)]
    df = spark.createDataFrame(rows, "key string, at long, n long")
    assert {r.key: r.out_of_order for r in X.out_of_order(df, "key", ["at"], "n").collect()} == {"a": False, "b": True, "c": False, "d": False}
    maps = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 3, "c": None}), (None, {"x": 1}), ({"y": 1}, None), (None, None)], "p map<string,int>, q map<string,int>")
    assert [r.m for r in maps.select(X.merged(F.col("p"), F.col("q")).alias("m")).collect()] == [{"a": 1, "b": 3, "c": None}, {"x": 1}, {"y": 1}, None]
    texts = spark.createDataFrame([(1, "aaaa\n\n bb \n\n\n\n"), (2, "one"), (3, None), (4, "aaaa\n\nbbbb")], "k long, t string")
    got = {r.k: (r.n, r.mean, round(r.spread, 6), r.score) for r in X.paragraph_spread(texts, "k", "t").collect()}
    assert got == {1: (2, 3.0, 1.414214, 0.8), 2: (1, 3.0, 0.0, 0.5), 3: (0, None, 0.0, 0.0), 4: (2, 4.0, 0.0, 0.5)}


def test_schedule_and_statistics(spark):
    rows = [(1, "queued", 2, 5, None, None, None, None), (2, "queued", 1, 5, None, None, None, {"memory": 3.0}), (3, "queued", 1, 1, 50, None, 80, None), (4, "failed", 1, 1, None, None, None, None), (5, "prioritized", 9, 9, 10, 200, None, None), (6, "queued", 1, 1, None, None, None, {"memory": 9.0}), (7, "queued", 1, 1, None, None, None, {"gpu": 1.0})]
    df = spark.createDataFrame([(*r, 0) for r in rows], "id long, state string, priority int, created long, scheduled long, earliest long, latest long, needs map<string,double>, owner int")
    got = [(r.id, r.overdue) for r in sorted(X.schedule(df, F.lit(100), {"memory": 4.0}).collect(), key=lambda r: r.place)]
    assert got == [(3, True), (2, False), (1, False)]
    log = spark.createDataFrame([(1, 10.0, 1, "good"), (1, 20.0, 0, "poor"), (1, 30.0, 0, "good"), (2, 5.0, 2, "poor")], "k long, ms double, critical int, level string")
    out = {r.k: (r.assessments, r.mean, round(r.critical_rate, 6), r.levels) for r in X.validation_statistics(log, "k", "ms", "critical", "level").collect()}
    assert out == {1: (3, 20.0, 0.333333, {"good": 2, "poor": 1}), 2: (1, 5.0, 2.0, {"poor": 1})}


def test_recovery_by_hand(spark):
    rows = [
        (1, "linear_backoff", 0, 3, 2, None, None), (2, "linear_backoff", 1, 3, None, None, None), (3, "exponential_backoff", 0, 4, 9, None, None), (4, "graceful_degradation", 0, 1, None, "d", "c"),
        (5, "graceful_degradation", 0, 1, None, None, "c"), (6, "graceful_degradation", 0, 1, None, None, None), (7, "manual_intervention", 0, 3, 1, None, None), (8, "linear_backoff", 3, 3, 3, None, None),
        (9, "immediate_retry", 0, 2, 1, None, None), (10, "checkpoint_restore", 0, 2, 1, "d", "c"),
    ]
    df = spark.createDataFrame(rows, "id long, strategy string, retries int, max_retries int, works_at int, degraded string, cached string").withColumns({"factor": F.lit(2.0), "severity": F.lit("low"), "category": F.lit("network")})
    log = sorted((r.id, r.attempt, r.delay, r.success) for r in L.recovery_attempts(df, "works_at").collect())
    assert log == [(1, 1, 10.0, False), (1, 2, 20.0, True), (2, 2, 20.0, False), (2, 3, 30.0, False), (3, 1, 5.0, False), (3, 2, 10.0, False), (3, 3, 20.0, False), (3, 4, 40.0, False), (9, 1, 0.0, True)]
    out = L.recovered(df, "works_at", "degraded", "cached")
    got = {r.id: (r.action, r.value, r.resolved, r.attempts, r.successes) for r in out.collect()}
    assert got == {
        1: ("retry", None, True, 2, 1), 2: ("retry", None, False, 2, 0), 3: ("retry", None, False, 4, 0), 4: ("degrade", "d", True, 0, 0), 5: ("degrade", "c", True, 0, 0),
        6: ("degrade", None, False, 0, 0), 7: ("raise", None, False, 0, 0), 8: ("give_up", None, False, 0, 0), 9: ("retry", None, True, 1, 1), 10: ("restore", None, False, 0, 0),
    }
    stats = {(r.by, r.name): (r.n, r.resolved, r.attempts, r.successes) for r in L.error_statistics(out).collect()}
    assert stats["all", ""] == (10, 4, 9, 2) and stats["strategy", "graceful_degradation"] == (3, 2, 0, 0) and stats["severity", "low"] == stats["category", "network"] == stats["all", ""]


def test_report_score_is_rounded_by_its_binary_value(spark):
    scores = [0.0625, 1.0005, 0.0435, 0.1875, 2.0, None]
    df = spark.createDataFrame([(k, s, 1, 0, 0, 1, {"error": 1}) for k, s in enumerate(scores)], "k long, score double, n long, passed long, warned long, failed long, severities map<string,long>")
    got = {r.k: r.report.split("Quality Score: ")[1].split("\n")[0] for r in L.validation_report(df, "k").collect()}
    assert got == {k: "null" if s is None else f"{s:.3f}" for k, s in enumerate(scores)} and got[0] == "0.062" and got[1] == "1.000"


def test_letters_and_votes_are_counted_by_runs(spark):
    texts = ["the cat. the, and\tof", " the the the ", "", "le la, DE und\nder x", "é😀 . , !?x", "und", "a\x0bthe b", "\nthe."]
    df = spark.createDataFrame([(t, "en", "s") for t in texts], "text string, lang string, source string")
    told = applied(df, Q.assessed)
    got = [(r.text, r.letters, r.v_en, r.v_fr, r.v_de) for r in told.collect()]
    count = lambda t, p: len(re.findall(p, t, re.A))
    assert got == [(t, count(t, r"[^\s.,;:!?]"), *(count(t.lower(), rf"(?:^|\s)(?:{Q.STOP_WORDS[k]})[\s.,]") for k in ("en", "fr", "de"))) for t in texts]
    # One match for each letter would be an array of them all.
    plan = told.select("letters")._jdf.queryExecution().optimizedPlan().toString()
    assert "[^\\s.,;:!?]" in plan and "[^\\s.,;:!?], 0" not in plan
