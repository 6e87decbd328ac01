"""Fill-in-the-middle: documents cut in three and told with their middle last.

An Arrow-batched pandas UDF takes whole texts. finditer of the regex library collects the end offset of every unit in
a compact array; two lookups there slice the text. Cuts and form come from SHA-256 of a seed and the document's id, so
a lost task gives the same rows again. restore() rebuilds a text from the told one and its form alone.

Units are the matches of `unit`, left to right; what no match covers belongs to the unit that follows it, or after the
last match to the suffix.

Defined cases
    null text: as the empty text, which stays plain with n = 0. Null doc_id: hashes like an empty id.
    texts that hold a mark stay plain, so restore() never meets a mark of the text's own.
    texts of any length: whole, with four bytes for each unit beside them. Ties: both cuts may be equal, the middle then is empty.
    repeated rows and empty tables: row by row. Extra columns are carried by fill(), whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import fresh, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A code point; any pattern that never matches the empty text may stand here, say words or lines.
CODE_POINT = r"(?s:.)"
#: Of a hundred documents so many are cut, and of these so many are told suffix first.
RATE, SUFFIX_FIRST, SEED = 90, 20, 1
TOLD = "n long, form string, prefix_chars long, middle_chars long, told string"


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transform(text: str, doc_id: int | None, unit: regex.Pattern, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> tuple:
    """n, form, prefix_chars, middle_chars, told."""
    ends = array("I", (m.end() for m in unit.finditer(text)))
    n, (h1, h2, h3, h4) = len(ends), draws(seed, doc_id)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(told: str, form: str) -> str:
    """The text that transform() has told in this form."""
    if form == "plain":
        return told
    second = {"psm": SUFFIX, "spm": PREFIX}[form]
    at = told.index(second, len(PREFIX))
    end = told.index(MIDDLE, at + len(second))
    one, two, middle = told[len(PREFIX) : at], told[at + len(second) : end], told[end + len(MIDDLE) :]
    return one + middle + two if form == "psm" else two + middle + one


def teller(unit: str = CODE_POINT, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED):
    """A pandas UDF of text and doc_id."""

    @F.pandas_udf(TOLD)
    def told(texts: pd.Series, ids: pd.Series) -> pd.DataFrame:
        pattern = regex.compile(unit)
        rows = [transform(t or "", None if i == "" else i, pattern, rate, suffix_first, seed) for t, i in zip(texts, ids)]
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "told"])
        return out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return told


def restored(told: Column, form: Column) -> Column:
    """restore() of two columns."""

    @F.pandas_udf("string")
    def run(told: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([restore(t, f) for t, f in zip(told, form)], dtype=object)

    return run(told, form)


def fill(docs: DataFrame, unit: str = CODE_POINT, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, into: str = "fim") -> DataFrame:
    """docs with a struct column `into` (n, form, prefix_chars, middle_chars, told)."""
    # Ids travel as text: pandas would turn a column of numbers with nulls into floating point.
    told = teller(unit, rate, suffix_first, seed)(F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.withColumn(into, told)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    name = fresh(docs, "fim")
    told = fill(docs, into=name).select("doc_id", f"{name}.*")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return told.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("told")).alias("output_sha256"), sha(restored(F.col("told"), F.col("form"))).alias("restored_sha256")
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (SELECT doc_id, t, length(t) AS n, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT for k in [0, 1, 2, 3]] AS h FROM d),
f AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
    WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM g
"""
