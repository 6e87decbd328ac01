"""Reports landed as whole files: the first name that exists wins."""

import os

from pyspark.sql import functions as F

from lectern.sources import landed


def land(top, files):
    for name, data in files.items():
        os.makedirs(os.path.dirname(f"{top}/{name}"), exist_ok=True)
        with open(f"{top}/{name}", "wb") as f:
            f.write(data)


def test_first_existing_name_wins(spark, tmp_path):
    top = f"{tmp_path}/landed here+1"
    land(top, {"A_EN.html": b"a html", "A_EN.xml": b"a xml", "CRE/B_EN.html": "b é".encode(), "document/B_EN": b"later", "C_EN.html": b"", "document/C_EN": b"c", "D_FR.html": b"other language", "E.html": b"no language"})
    wanted = spark.createDataFrame([(s,) for s in ("A", "B", "C_EN", "D", "E", None, "A")], "session_id string")
    out = sorted(((r.session_id or "", r.path, r.tried, r.content) for r in landed.first_reports(landed.landed_files(spark, top), wanted).collect()), key=str)
    assert out == [
        ("", None, 4, None), ("A", "A_EN.html", 1, "a html"), ("A", "A_EN.html", 1, "a html"), ("B", "CRE/B_EN.html", 3, "b é"), ("C_EN", "document/C_EN", 4, "c"), ("D", None, 4, None), ("E", None, 4, None),
    ]
    french = landed.first_reports(landed.landed_files(spark, top), wanted.where("session_id = 'D'"), language="FR").first()
    assert french.content == "other language"


def test_addresses_and_documents_of_sessions(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-15",), ("2024-01",), ("x-y-z",), (None,), ("1-2-3-4",)], "d string")
    assert [r.a for r in df.select(landed.report_address(F.col("d"), "b").alias("a")).collect()] == ["b/CRE-9-2024-01-15_EN.html", None, "b/CRE-9-x-y-z_EN.html", None, None]
    land(f"{tmp_path}/api", {"sessions/s1/documents.json": b'{"results": [{"id": "1", "title": "t"}, {"id": "2", "type": "k"}]}', "sessions/s2/documents.json": b'{"results": [{"id": "3"}]}', "sessions/s3/documents.json": b"broken"})
    wanted = spark.createDataFrame([("s1",), ("s3",), ("s1",)], "session_id string")
    out = landed.session_documents(landed.landed_files(spark, f"{tmp_path}/api"), wanted)
    assert sorted(map(tuple, out.collect())) == [("s1", "1", "t", None), ("s1", "2", None, "k")]
