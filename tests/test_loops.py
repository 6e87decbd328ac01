"""Loops by hand, and a stream of windows against the batch."""

import os
from datetime import datetime, timedelta

from lectern.streaming import loops


def test_monitoring_by_hand(spark):
    h = 3600.0
    df = spark.createDataFrame([(0.0, 9 * h), (0.0, None), (0.0, 2 * h), (4 * h, 4.5 * h)], "start double, end double")
    out = {r.tick / h: (r.stuck, r.evicted) for r in loops.monitored(df, 11 * h).collect()}
    # the first two are stuck from 6.5 h on, the first until it goes at 10.5 h; the others go before they are stuck
    assert out == {3.5: (0, 1), 6.0: (0, 1), 6.5: (2, 0), 10.5: (2, 1), 11.0: (1, 0)}


def test_quality_by_hand(spark):
    hour = 3600.0
    rows = [(i, 1, i * 60.0, 0.2) for i in range(9)] + [(9, 1, 3 * hour, 0.9)] + [(100 + i, 2, 8 * 86400.0 + i, 1.0) for i in range(150)] + [(i, 2, 10.0, 0.0) for i in range(300, 305)] + [(400, 3, 5.0, 1.0)]
    out = {(r.key, r.tick / hour): (r.n, round(r.mean, 6), r.alert) for r in loops.quality(spark.createDataFrame(rows, "id long, key long, end double, quality double"), "key").collect()}
    assert out == {(1, 4.0): (10, 0.27, True), (2, 193.0): (100, 1.0, False)}
    assert loops.quality(spark.createDataFrame([], "id long, key long, end double, quality double"), "key").count() == 0


def test_discovery_and_windows_of_a_stream(spark, tmp_path):
    begin = datetime(2024, 1, 1)
    rows = [(i, begin + timedelta(minutes=17 * i), i % 3, float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, at timestamp, key long, value double")
    for k in range(3):
        df.where(f"id DIV 40 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    loops.start(loops.tumbling(stream, "at", loops.QUALITY, "key", "value"), f"{tmp_path}/out").awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/rows").collect()}
    want = {tuple(r) for r in loops.tumbling(df, "at", loops.QUALITY, "key", "value").collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and os.path.isdir(f"{tmp_path}/out/progress")
    query = loops.start(loops.tumbling(stream, "at", loops.QUALITY, "key", "value"), f"{tmp_path}/timed", every=1)
    query.processAllAvailable()
    query.stop()
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/timed/rows").collect()} == got
    assert sorted((r.tick, r.n) for r in loops.discovered(spark.createDataFrame([(0.0,), (21599.0,), (21600.0,)], "created double")).collect()) == [(21600, 2), (43200, 1)]
