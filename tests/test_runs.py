"""A run that is lost and goes on equals one that was not; the post-processor by hand."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import runs


def test_post_processor_by_hand(spark):
    rows = [
        (1, "Mr Smith (PPE). – ", "<p>Ten &amp; more</p> words", 0.5), (2, "Anna Berg", "<style>x{}</style><b>enough text</b>", 0.5), (3, "J. Meyer", "long enough text", 0.5),
        (4, "President: ", "long enough text", 0.5), (5, "Anna Berg", "<p>short</p>", 0.5), (6, None, "long enough text", 0.5), (7, "Anna Berg", "long enough text", 0.05), (8, "Anna Berg", None, 0.5),
    ]
    df = spark.createDataFrame(rows, "id long, speaker string, text string, confidence double")
    out = {r.id: (r.speaker, r.text, r.enhanced) for r in runs.enhanced(df, confidence="confidence").collect()}
    assert out == {1: ("Smith", "Ten & more words", True), 2: ("Anna Berg", "enough text", True)}


def test_simple_announcements(spark):
    long = "word " * 25
    rows = [("short", None), (long, None), (long, "The Vice-President"), (long + "I call upon you", "x"), (long + "The sitting is opened", None), (None, None), (long + "voting", "member")]
    df = spark.createDataFrame(rows, "text string, role string")
    assert [r.a for r in df.select(runs.simple_announcement(F.col("text"), F.col("role")).alias("a")).collect()] == [True, False, True, True, True, True, False]


def test_an_interrupted_run_equals_an_uninterrupted_one(spark, tmp_path):
    sessions = spark.createDataFrame([(i,) for i in range(10)], "session_id long")
    seen = []
    phases = [
        ("collect", lambda s: s.withColumn("part", F.explode(F.array(F.lit(1), F.lit(2))))),
        ("note", lambda r: (seen.append(r.count()), r)[1]),
        ("output", lambda r: r.withColumn("out", F.col("session_id") * 10 + F.col("part"))),
    ]
    run = runs.Run(spark, f"{tmp_path}/a", phases)
    assert run.result() is None
    run.go(sessions, limit=3)
    with pytest.raises(RuntimeError):
        run.go(sessions, stop_before="output")
    assert run.result().count() == 6 and len(run.batches()) == 1
    again = runs.Run(spark, f"{tmp_path}/a", phases)  # another driver
    assert again.pending(sessions, limit=4).count() == 1
    again.go(sessions)
    assert seen == [6, 14, 14] and again.pending(sessions).count() == 0
    once = runs.Run(spark, f"{tmp_path}/b", phases)
    once.go(sessions)
    assert sorted(again.result().collect()) == sorted(once.result().collect())
    again.go(sessions)
    assert again.result().count() == 20
