"""Writers and landed-file readers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.sources.stores import Files

OUTPUT = ["speaker_name", "speaker_country", "speaker_party_or_group", "segment_start_ts", "segment_end_ts", "speech_text", "is_announcement", "announcement_label"]


#: With metadata these follow, with what stands for a null.
METADATA = {"confidence": "0.0", "resolution_method": "", "timestamp_method": "", "classification_confidence": "0.0"}


def projected(segments: DataFrame, metadata: bool = False) -> DataFrame:
    """The output columns as strings, nulls as empty strings, speech without white space around it; a column that
    segments lack is empty. A null is_announcement is false, null confidences are 0.0."""
    known = set(segments.columns)
    defaults = {c: "false" if c == "is_announcement" else "" for c in OUTPUT} | (METADATA if metadata else {})
    value = lambda c: F.col(c).cast("string") if c in known else F.lit(None).cast("string")
    out = {c: F.coalesce(value(c), F.lit(d)) for c, d in defaults.items()}
    out["speech_text"] = F.regexp_replace(out["speech_text"], r"^\s+|\s+$", "")
    return segments.select(*(v.alias(c) for c, v in out.items()))


def write_output(segments: DataFrame, path: str, formats: tuple[str, ...] = ("csv", "jsonl"), metadata: bool = False) -> dict:
    """A folder of part files for each format, written by all tasks; quality.json and README.md beside them, from
    figures that the first write observes in passing. Returns these figures and the files' places."""
    out, seen = projected(segments, metadata), Observation()
    share = lambda c: F.count_if(F.col(c) != "")
    figures = {
        "segments": F.count("*"), "announcements": F.count_if(F.col("is_announcement") == "true"), "with_speaker": share("speaker_name"), "with_country": share("speaker_country"),
        "with_times": F.count_if((F.col("segment_start_ts") != "") & (F.col("segment_end_ts") != "")), "characters": F.coalesce(F.sum(F.length("speech_text")), F.lit(0)),
    }
    writers = {
        "csv": lambda df: df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("emptyValue", "").csv(f"{path}/csv"),
        "jsonl": lambda df: df.write.mode("overwrite").json(f"{path}/jsonl"),
    }
    for k, name in enumerate(formats):
        writers[name](out if k else out.observe(seen, *(v.alias(c) for c, v in figures.items())))
    told = dict(seen.get) | {"files": {f: f"{path}/{f}" for f in formats}}
    files = Files(segments.sparkSession, path)
    for name, text in (("quality.json", json.dumps(told, indent=1)), ("README.md", _readme(told, out.columns))):
        files.remove(f"{path}/{name}")
        files.publish(f"{path}/{name}", text)
    return told


def _readme(told: dict, columns: list[str]) -> str:
    rows = [f"| {k} | {v} |" for k, v in told.items() if k != "files"]
    return "\n".join(["# Segments", "", f"Columns: {', '.join(columns)}.", f"Files: {', '.join(told['files'])}.", "", "| figure | value |", "|-|-|", *rows, ""])


def read_output(spark: SparkSession, path: str, kind: str = "csv", metadata: bool = False) -> DataFrame:
    columns = [*OUTPUT, *(METADATA if metadata else ())]
    schema = ", ".join(f"{c} string" for c in columns)
    if kind == "jsonl":
        return spark.read.schema(schema).json(f"{path}/jsonl")
    read = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    return read.csv(f"{path}/csv").na.fill("")


def write_sessions(sessions: DataFrame, path: str, times: tuple[str, ...] = (), spans: tuple[str, ...] = ()) -> None:
    """Session records as JSON lines: times as ISO text, spans (intervals) in seconds, other columns as they are."""
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in times}
    seconds = {c: F.expr(f"extract(DAY FROM {c}) * 86400 + extract(HOUR FROM {c}) * 3600 + extract(MINUTE FROM {c}) * 60 + extract(SECOND FROM {c})").cast("double") for c in spans}
    sessions.withColumns(iso | seconds).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_results(spark: SparkSession, path: str, schema: str, field: str = "results") -> DataFrame:
    """Landed API answers: one row per element of the array `field`."""
    answers = spark.read.schema(f"{field} array<struct<{schema}>>").option("multiLine", True).json(path)
    return answers.select(F.explode(field).alias("r")).select("r.*")


def fresh(table: DataFrame, created: str, now: str, hours: float) -> DataFrame:
    """Rows of a cache table that are still valid at the time in the column or literal `now`."""
    return table.where(F.col(created) > F.to_timestamp(F.lit(now)) - F.make_dt_interval(hours=F.lit(int(hours))))
