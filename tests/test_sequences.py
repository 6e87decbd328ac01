import random

from lectern.operators import pages as P
from lectern.operators import sequences as S
from lectern.streaming import stream


def test_breaker_opens_waits_and_closes():
    b = S.Breaker()
    assert [b.step(t, False)[1] for t in range(5)] == ["closed"] * 4 + ["open"]
    assert b.step(30, True) == (False, "open")
    assert [b.step(70 + t, True)[1] for t in range(3)] == ["half_open", "half_open", "closed"]
    variant = S.Breaker(close_at_once=True)
    for t in range(5):
        variant.step(t, False)
    assert variant.step(70, True) == (True, "closed")
    b = S.Breaker()
    for t in range(5):
        b.step(t, False)
    assert b.step(70, False) == (True, "open") and b.step(100, True)[0] is False


def test_breaker_over_rows_equals_the_loop(spark):
    rng = random.Random(1)
    rows = [(i, i % 3, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", rng.random() < 0.6) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, k long, ts string, ok boolean").selectExpr("event_id", "k", "to_timestamp(ts) AS ts", "ok").repartition(5)
    got = {r.event_id: (r.allowed, r.state) for r in S.breaker_states(df, "k", "ts", "event_id", "ok").collect()}
    want, breakers = {}, [S.Breaker() for _ in range(3)]
    for i, k, _, ok in rows:
        want[i] = breakers[k].step(float(i), ok)
    assert got == want


def test_breaker_stream(spark, tmp_path):
    events = [(i, i % 2, "error" if i % 20 < 12 else "view", f"2024-01-01 00:00:{i % 60:02d}") for i in range(60)]
    df = spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts string").selectExpr("event_id", "user_id", "event_type", "to_timestamp(ts) AS ts")
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = stream.breaker_stream(source).writeStream.format("memory").queryName("breaker").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {r.event_id: (r.allowed, r.state) for r in spark.table("breaker").collect()}
    want, breakers = {}, [S.Breaker(), S.Breaker()]
    for i, u, kind, _ in events:
        want[i] = breakers[u].step(float(i), kind != "error")
    assert got == want


def test_names_and_similarity(spark):
    assert S.plain_name("Mr García Pérez (PPE)") == "Garci a Pe rez" and S.plain_name("President") == "" and S.plain_name(None) == ""
    members = spark.createDataFrame([("Anna Berg",), ("Lena Ruiz",)], "member string")
    names = spark.createDataFrame([("anna berg",), ("Berg Anna",), ("Lena Ruis",), ("Zzz Qqq",), ("Zzz Qqq",)], "name string")
    out = {r.name: (r.member, r.method) for r in S.resolved_names(names, members).collect()}
    assert out == {"anna berg": ("Anna Berg", "exact"), "Berg Anna": ("Anna Berg", "fuzzy"), "Lena Ruis": ("Lena Ruiz", "fuzzy"), "Zzz Qqq": (None, "none")}


def test_elements_and_clean_text():
    html = "<html><head><style>x{}</style></head><body><div class='contents'><p>One &amp; two</p><br><p class=menu>Go</p></div><script>no()</script></body></html>"
    found, text = P.walk(html)
    assert [(t, c, x) for _, t, c, x in found] == [("div", "contents", "One & twoGo"), ("p", "", "One & two"), ("p", "menu", "Go")]
    assert "no()" not in text and P.clean_text("<p>a  b</p>\n<p> c </p>") == "a b c" and P.walk(None) == ([], "")


def test_elements_leave_a_worker_in_small_parts(spark, monkeypatch):
    """A batch of nested pages is never one frame of all its elements."""
    pages = spark.range(1, 9, numPartitions=1).selectExpr("id AS page_id", "concat(repeat('<div>', 60), repeat('word and more ', 2000), repeat('</div>', 60)) AS html")
    plain = P.elements(pages)
    run = []
    monkeypatch.setattr(type(pages), "mapInPandas", lambda self, f, schema: run.append(f) or plain)
    P.elements(pages)
    frames = list(run[0](iter([pages.toPandas()])))
    assert sum(map(len, frames)) == 8 * 60 and max(int(f["text"].str.len().sum()) for f in frames if len(f)) < 2 * 60 * 28_000
    got = plain.groupBy("page_id").count().collect()
    assert sorted(map(tuple, got)) == [(i, 60) for i in range(1, 9)]


def test_band_join_takes_the_best_mark(spark):
    marks = spark.createDataFrame([(1, 100, 0.8), (1, 180, 0.8), (1, 900, 0.8)], "key long, pos long, weight double")
    spots = spark.createDataFrame([(1, 150), (1, 600), (1, 1100)], "key long, spot long")
    got = {(r.spot, r.pos) for r in S.near_marks(marks, spots).collect()}
    assert got == {(150, 180), (1100, 900)}
