"""Stage life cycles: by hand, as a stream against the batch, and the timers of stuck and finished operations."""

import random
from datetime import datetime, timedelta

from lectern.streaming import stages as S

NAMES = ["find", "parse", "store"]
EVENTS = "operation long, seq long, at timestamp, stage string, kind string, percent double, items double, final boolean"
START = datetime(2024, 1, 1)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_one_operation_by_hand():
    s = S.Stages(NAMES)
    assert s.step(0, "find", "progress", 130.0, 5, False) == ("in_progress", 100.0, 0.0, 0, None, 100 / 3, "running")
    assert s.step(10, "parse", "progress", -4.0, 20, False) == ("in_progress", 0.0, 0.0, 0, "find", 100 / 3, "running")
    assert s.step(14, "parse", "progress", 50.0, 20, False)[:3] == ("in_progress", 50.0, 5.0)
    assert s.step(15, "parse", "fail", None, None, False) == ("failed", 50.0, 5.0, 1, None, 50.0, "running")
    assert s.step(16, "parse", "retry", None, None, False)[:2] == ("in_progress", 0.0)
    assert s.step(17, "find", "progress", 100.0, None, False)[4] is None  # parse stands at 0
    assert s.step(18, "parse", "complete", None, None, False)[0] == "completed"
    assert s.step(19, "store", "progress", 100.0, 1, False)[4:] == ("find", 100.0, "running")
    assert s.step(20, "store", "complete", None, None, False)[-1] == "completed"
    assert s.step(21, "store", "fail", None, None, True)[-1] == "failed"


def events(n):
    rng = random.Random(3)
    return [
        (rng.randrange(6), k, START + timedelta(seconds=7 * k), rng.choice(NAMES), rng.choice(["progress"] * 5 + ["fail", "retry", "complete"]), rng.choice([None, 20.0, 60.0, 100.0, 140.0]), rng.choice([None, 3.0, 40.0]), rng.random() < 0.02)
        for k in range(n)
    ]


def test_stream_equals_batch_and_timers_fire(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    data = events(120)
    # an operation that finishes, one that hangs, and a late event that moves the watermark past both
    end = START + timedelta(hours=1)
    data += [(90, 1000 + k, end, n, "complete", None, None, False) for k, n in enumerate(NAMES)] + [(91, 1010, end, "find", "progress", 5.0, 1.0, False)]
    last = [(99, 2000, end + timedelta(hours=9), "find", "progress", 1.0, 1.0, False)]
    flush = [(99, 2001, end + timedelta(hours=9, minutes=1), "find", "progress", 2.0, 1.0, False)]
    for rows in (data[:60], data[60:], last, flush):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = S.stage_stream(stream, NAMES).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.schema(S.TOLD).parquet(f"{tmp_path}/out")
    batch = S.stage_states(spark.createDataFrame(data + last + flush, EVENTS).repartition(3), NAMES)
    assert told(out.where("seq IS NOT NULL")) == told(batch)
    marks = {(r.operation, r.status) for r in out.where("seq IS NULL").collect()}
    assert {(90, "evicted"), (91, "stuck")} <= marks and not any(o == 99 for o, _ in marks)


def test_closing(spark):
    at = lambda h: START + timedelta(hours=h)
    df = spark.createDataFrame([(1, at(0), "running"), (2, at(5), "running"), (3, at(5.5), "failed"), (4, at(6.5), "completed"), (5, at(5), "completed")], "operation long, last timestamp, status string")
    assert {(r.operation, r.verdict) for r in S.closing(df, at(7)).collect()} == {(1, "stuck"), (3, "evicted"), (5, "evicted")}


def test_empty(spark):
    assert S.stage_states(spark.createDataFrame([], EVENTS), NAMES).count() == 0
