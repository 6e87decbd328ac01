import hashlib
from collections import Counter

import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import fill_middle as fm
from tests.llm.fixtures import DOCS, awkward_docs, prose, rows

POINT = regex.compile(fm.CODE_POINT)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="<>PSM a\né😀", max_size=30), st.integers(-5, 10**12))
def test_told_texts_are_restored(text, doc_id):
    n, form, a, m, told = fm.transform(text, doc_id, POINT)
    assert n == len(text) and fm.restore(told, form) == text
    if form == "plain":
        assert told == text and a is None
    else:
        at = 3 if form == "psm" else told.index("<P>", 3) + 3
        assert told[at : at + a] == text[:a] and told.endswith("<M>" + text[a : a + m])


def test_cuts_and_forms_by_hand():
    h = hashlib.sha256(b"1:42").hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n, form, a, m, _ = fm.transform("abcdefghij", 42, POINT)
    want = "plain" if h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
    assert (n, form) == (10, want) and (a, m) == ((None, None) if want == "plain" else (min(h1 % 11, h2 % 11), abs(h1 % 11 - h2 % 11)))
    forms = Counter(fm.transform("some text", i, POINT)[1] for i in range(3000))
    assert abs(forms["plain"] / 3000 - 0.1) < 0.03 and abs(forms["spm"] / 3000 - 0.18) < 0.03


def test_words_as_units():
    unit = regex.compile(r"\s*\S+")
    for i in range(60):
        text = prose(i, 25) + "\n "
        n, form, a, m, told = fm.transform(text, i, unit)
        assert n == 25 and fm.restore(told, form) == text
        assert form == "plain" or all(k in {0, *(x.end() for x in unit.finditer(text))} for k in (a, a + m))


def test_fill_equals_rows_and_awkward_rows(spark):
    long = "é<" * 200_000
    docs = awkward_docs(spark, extra=["has <M> a mark", long, *(prose(k, 30) for k in range(30))]).withColumns({"fim": F.lit("own"), "n": F.lit(1)})
    out = fm.fill(docs, into="__fim")
    assert out.columns[:-1] == docs.columns
    got = Counter((r.doc_id, r.text, *r["__fim"]) for r in out.repartition(3).collect())
    assert got == Counter((r.doc_id, r.text, *fm.transform(r.text or "", r.doc_id, POINT)) for r in docs.collect())
    assert all(r.fim == "own" for r in out.collect())
    assert fm.fill(docs.limit(0), into="__fim").count() == 0


def test_query_restores_every_text(spark, tmp_path):
    docs = spark.createDataFrame(rows([prose(k, 40) + " €" for k in range(40)]) + [(None, "x", "en", "s", 1), (1, None, "en", "s", 1)], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = fm.op13_fill_middle(spark, str(tmp_path)).collect()
    want = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    assert Counter((r.doc_id, r.restored_sha256) for r in out) == want
