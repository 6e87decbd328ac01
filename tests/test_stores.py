"""Stores that survive lost writers, the event log across a restart, and outputs read back."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.operators import lifecycle as L
from lectern.sources import sinks
from lectern.sources.stores import Cache, Checkpoints
from lectern.streaming import event_log

ROWS = "id long, v string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_versions_changes_and_compaction(spark, tmp_path):
    store = Checkpoints(spark, str(tmp_path))
    assert store.save("t", spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], ROWS), "id") == 1
    assert store.save_changes("t", spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], ROWS), "id") == 2
    changed = spark.read.parquet(f"{tmp_path}/t/data/{store.manifest('t')['parts'][-1]}")
    assert sorted((r.id, r["__gone"]) for r in changed.collect()) == [(2, False), (3, True), (4, False)]
    assert store.save_changes("t", spark.createDataFrame([(3, "back"), (4, None)], ROWS), "id") == 3
    assert rows(store.load("t", 1)) == [(1, "a"), (2, "b"), (3, None)] or len(rows(store.load("t", 1))) == 3
    assert rows(store.load("t", 2)) == [(1, "a"), (2, "B"), (4, "d")]
    assert sorted(store.load("t").collect()) == sorted([(3, "back"), (4, None)]) and store.compact("t") == 4
    assert sorted(store.load("t", 4).collect()) == sorted([(3, "back"), (4, None)])
    assert [tuple(r) for r in store.list().collect()] == [("t", 4, "full", 1), ("t", 3, "changes", 3), ("t", 2, "changes", 2), ("t", 1, "full", 1)]
    for v in (1, 2):
        store.delete("t", v)
    assert store.versions("t") == [3, 4] and sorted(store.load("t", 3).collect()) == sorted([(3, "back"), (4, None)])
    store.delete("t", 3)
    assert len(os.listdir(f"{tmp_path}/t/data")) == 1
    with pytest.raises(KeyError):
        store.load("t", 3)
    store.delete("t")
    assert store.versions("t") == []


def test_a_lost_writer_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = Checkpoints(spark, str(tmp_path))
    store.save("t", spark.createDataFrame([(1, "a")], ROWS), "id")
    monkeypatch.setattr(store.files, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.save("t", spark.createDataFrame([(1, "new")], ROWS), "id")
    monkeypatch.undo()
    assert rows(Checkpoints(spark, str(tmp_path)).load("t")) == [(1, "a")]
    store.save("t", spark.createDataFrame([(1, "next")], ROWS), "id")
    assert rows(store.load("t")) == [(1, "next")]
    with pytest.raises(FileExistsError):  # of two writers of one version the second learns of it
        store.files.publish(f"{tmp_path}/t/versions/2.json", "{}")
    assert rows(store.load("t")) == [(1, "next")]


def test_restore_modes(spark, tmp_path):
    store = Checkpoints(spark, str(tmp_path))
    store.save("t", spark.createDataFrame([(1, "done"), (2, "open")], ROWS), "id")
    current = spark.createDataFrame([(2, "later"), (3, "own")], ROWS)
    at = lambda mode: rows(store.restore("t", current, mode, done=F.col("v") == "done"))
    assert at("full") == [(1, "done"), (2, "open")] and at("partial") == [(1, "done")] and at("merge") == at("incremental") == [(1, "done"), (2, "open"), (3, "own")]
    with pytest.raises(ValueError):
        at("other")


def test_cache_hits_expires_and_leaves_other_partitions(spark, tmp_path):
    calls = []

    def compute(missing):
        calls.append(rows(missing))
        return missing.withColumn("value", F.concat(F.lit(f"v{len(calls)}-"), "key"))

    cache = Cache(spark, str(tmp_path), L.cache_hours, shards=16)
    asked = lambda *keys: spark.createDataFrame([(k, "document_links") for k in keys], "key string, kind string")
    ask = lambda now, *keys: sorted((r.key, r.value, r.hit) for r in cache.through(asked(*keys), compute, now * 3600).collect())
    files = lambda: {f"{d}/{f}" for d, _, fs in os.walk(tmp_path) for f in fs if "/shard=" in d and f.endswith(".parquet")}
    keys = [f"k{i}" for i in range(40)]
    assert all(not hit for *_, hit in ask(0, *keys, "k0"))
    before = files()
    assert all(hit and value == f"v1-{k}" for k, value, hit in ask(6, *keys)) and files() == before and calls[1] == []
    ask(1, "new")
    assert len(before - files()) == 1  # one partition was rewritten
    assert ask(6.5, "k0") == [("k0", "v4-k0", False)] and ask(7, "k0", "k0") == [("k0", "v4-k0", True)] * 2
    cache.put(spark.createDataFrame([("k0", "document_links", "old", 0.0)], "key string, kind string, value string, created double"), 7 * 3600.0)
    assert ask(7, "k0") == [("k0", "v4-k0", True)]
    assert not [f for f in os.listdir(tmp_path) if f.startswith("_staged")]


def write_events(spark, folder, k):
    data = [(k * 100 + i, i % 4, "error" if i % 5 == 0 else "view") for i in range(20)]
    spark.createDataFrame(data, "event_id long, operation long, event_type string").coalesce(1).write.mode("append").parquet(folder)


def test_restarted_log_equals_a_batch(spark, tmp_path):
    folder, top = f"{tmp_path}/events.parquet", f"{tmp_path}/log"
    for k in range(3):
        write_events(spark, folder, k)
    who = spark.createDataFrame([("a", 1), ("b", 2), ("all", None), ("a", 3)], "subscriber string, operation long")
    sinks_ = {"log": lambda b: b, "alerts": lambda b: b.where("event_type = 'error'"), "notes": lambda b: event_log.notifications(b, who)}
    stream = lambda: event_log.table_stream(spark, str(tmp_path), "events")
    with pytest.raises(Exception, match="stopped before alerts of batch 1"):
        event_log.fan_out(stream(), sinks_, top, fail_at=(1, "alerts"))
    assert event_log.read(spark, top, "log").count() == 40 and event_log.read(spark, top, "alerts").count() == 4
    event_log.fan_out(stream(), sinks_, top)
    write_events(spark, folder, 3)
    event_log.fan_out(stream(), sinks_, top)
    events = spark.read.parquet(folder)
    assert rows(event_log.read(spark, top, "log").drop("batch")) == rows(events)
    assert rows(event_log.read(spark, top, "alerts").drop("batch")) == rows(events.where("event_type = 'error'"))
    notes = Counter((r.subscriber, r.event_id) for r in event_log.read(spark, top, "notes").collect())
    want = Counter((s, r.event_id) for r in events.collect() for s, o in (("a", 1), ("b", 2), ("a", 3), ("all", None)) if o in (None, r.operation))
    assert notes == want
    assert event_log.read(spark, top, "log").select("batch").distinct().count() == 4


def test_output_figures_and_awkward_texts(spark, tmp_path):
    data = [("Ann", None, ' two\nlines, "quoted" ', True, "x", 0.5), (None, "FR", None, None, None, None), ("", "", "a;b\\c", False, "", 1.0)]
    df = spark.createDataFrame(data, "speaker_name string, speaker_country string, speech_text string, is_announcement boolean, announcement_label string, confidence double")
    told = sinks.write_output(df, str(tmp_path), metadata=True)
    want = {"segments": 3, "announcements": 1, "with_speaker": 1, "with_country": 1, "with_times": 0, "characters": 24}
    assert {k: told[k] for k in want} == want and json.load(open(f"{tmp_path}/quality.json")) == told
    out = sorted(["Ann", "", "", "", "", 'two\nlines, "quoted"', "true", "x", "0.5", "", "", "0.0"] if r[0] == "Ann" else ["", "FR" if r[1] else "", "", "", "", "" if r[1] else "a;b\\c", "false", "", "0.0" if r[1] else "1.0", "", "", "0.0"] for r in data)
    for kind in ("csv", "jsonl"):
        assert sorted(list(r) for r in sinks.read_output(spark, str(tmp_path), kind, metadata=True).collect()) == out
    assert "| segments | 3 |" in open(f"{tmp_path}/README.md").read()


def test_sessions_are_persisted_as_text(spark, tmp_path):
    df = spark.sql("SELECT 's1' AS id, TIMESTAMP '2024-01-02 03:04:05' AS created, INTERVAL '1 02:03:04.5' DAY TO SECOND AS spent, CAST(NULL AS STRING) AS error")
    sinks.write_sessions(df, f"{tmp_path}/s", times=("created",), spans=("spent",))
    assert [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/s").collect()] == [{"id": "s1", "created": "2024-01-02T03:04:05", "spent": 93784.5, "error": None}]
