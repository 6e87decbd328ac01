"""Reports and answers that were fetched and landed as whole files, found by the names they may have.

A fetcher lands what it gets under the path it asked for; what was not there has no file. The readers here take the first
name that exists, as the fetcher would have tried them in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The paths below the base address under which a report may lie, in order of trial.
CANDIDATES = ["{}.html", "{}.xml", "CRE/{}.html", "document/{}"]
#: Fixed value: a report's id by its session's date; year, month, day, language.
BY_DATE = "CRE-9-%s-%s-%s_%s"


def document_id(session: Column, language: str) -> Column:
    """The session's id with the language behind it, unless it ends with that."""
    end = f"_{language}"
    return F.when(F.lit(bool(language)) & ~F.endswith(session, F.lit(end)), F.concat(session, F.lit(end))).otherwise(session)


def report_address(date: Column, base: str, language: str = "EN") -> Column:
    """Where the report of a day (three parts with dashes between) lies; null for anything else."""
    parts = F.split(date, "-", -1)
    name = F.format_string(BY_DATE, F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.lit(language))
    return F.when(F.size(parts) == 3, F.concat(F.lit(base + "/"), name, F.lit(".html")))


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """path (below the folder), length and content of every file under a folder; Spark leaves empty files out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    top = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/")
    path = F.regexp_replace(F.col("path"), r"^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "/")
    return files.select(F.regexp_replace(path, "^" + _quoted(top) + "/", "").alias("path"), "length", "content")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_-" else "\\" + c for c in text)


def first_reports(files: DataFrame, wanted: DataFrame, language: str = "EN") -> DataFrame:
    """wanted (session_id) with path, tried (how many names were tried) and content (text) of its report: the file
    of the first name that exists, null if there is none. Names are chosen before contents are read or moved."""
    known = wanted.select("session_id").distinct().withColumn("__id", document_id(F.col("session_id"), language))
    names = F.array(*(F.concat(F.lit(c.partition("{}")[0]), F.col("__id"), F.lit(c.partition("{}")[2])) for c in CANDIDATES))
    tried = known.select("session_id", F.posexplode(names).alias("__k", "path"))
    chosen = tried.join(files.select("path"), "path", "left_semi").groupBy("session_id").agg(F.min(F.struct("__k", "path")).alias("__c"))
    paths = chosen.select("session_id", "__c.path", (F.col("__c.__k") + 1).alias("tried"))
    read = files.join(paths, "path").select("session_id", "path", "tried", F.decode("content", "UTF-8").alias("content"))
    return wanted.join(read, "session_id", "left").withColumn("tried", F.coalesce("tried", F.lit(len(CANDIDATES))))


def session_documents(answers: DataFrame, wanted: DataFrame) -> DataFrame:
    """Answers (path, content) on the documents of the wanted sessions, one row for each of their results: session_id, id,
    title, type. The path names the session."""
    told = answers.withColumn("session_id", F.regexp_extract("path", r"^sessions/([^/]+)/documents(?:\.json)?$", 1)).where("session_id <> ''")
    some = told.join(wanted.select("session_id").distinct(), "session_id", "left_semi")
    rows = F.from_json(F.decode("content", "UTF-8"), "results array<struct<id string, title string, type string>>")["results"]
    return some.select("session_id", F.explode(rows).alias("r")).select("session_id", "r.*")
