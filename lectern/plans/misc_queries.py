"""Registered queries on documents and pages, and those that need Python or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.functions.dialect import DUCK, SPARK, Spark, case
from lectern.operators import pages as P
from lectern.operators import quality as Q
from lectern.operators import sequences as S
from lectern.plans.layers import applied, written
from lectern.streaming import stream

# every second document carries a phrase, so that each arm of the rules has rows
PHRASES = ["THE AGENDA OF TODAY\n\nPresident: the European Parliament and the Commission", "However, the committee report and the opinion; therefore a vote.", "Mr President. The debate on the amendment: the Council, the policy, the law.", "sitting opens at 9:00 and the vote begins at 10:30:15", "a break until 14.30, then the session ends at 6:45 pm", "around 11 the speaker continues", "[note] 1. numbered\n\nshort"]


def _base(d: Spark) -> dict[str, str]:
    phrase = d.item(PHRASES, f"doc_id % {len(PHRASES)}")
    if d.name == "spark":
        phrase = "element_at(array(" + ", ".join("'" + p.replace("\n", "\\n") + "'" for p in PHRASES) + f"), cast(doc_id % {len(PHRASES)} as int) + 1)"
    return {"doc_id": "doc_id", "lang": "lang", "source": "source", "text": f"CASE WHEN doc_id % 2 = 0 THEN concat({phrase}, '. ', coalesce(text, '')) ELSE coalesce(text, '') END"}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*[F.expr(e).alias(c) for c, e in _base(SPARK).items()])


DOCUMENTS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _base(DUCK).items()) + " FROM documents"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def _documents(layers, columns: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return applied(documents(spark, sf_dir), layers).select("doc_id", *[F.expr(c.split(" AS ")[0]).alias(c.split(" AS ")[-1]) for c in columns])

    return run, f"SELECT doc_id, {', '.join(columns)} FROM ({written(DOCUMENTS_SQL, layers)})"


#: Words of reports over half of the pages, none to three of them, as the table's pages hold next to none.
REPORT_PHRASES = ["", "<p>The sitting</p>", "<p>Debate, sitting of the day</p>", "<p>PLENARY agenda: the president</p>"]
_REPORTS = "concat(html, CASE page_id % 8 " + " ".join(f"WHEN {k} THEN '{p}'" for k, p in enumerate(REPORT_PHRASES)) + " ELSE '' END)"


def _pages(layers, columns: list[str], html: str = "html"):
    source = f"SELECT page_id, url, {html} AS html FROM pages"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return applied(pages(spark, sf_dir).selectExpr("page_id", "url", f"{html} AS html"), layers).select("page_id", *columns)

    return run, f"SELECT page_id, {', '.join(columns)} FROM ({written(source, layers)})"


def _rounded(*names: str) -> list[str]:
    return [f"round({n}, 6) AS {n}" for n in names]


def _repeated(d: Spark) -> list[dict[str, str]]:
    """Grammar with its penalty for a word that is over a quarter of all; the count is an aggregation of its own."""
    return [*Q.structural(d), *Q.linguistic(d)]


def structure_counts(d: Spark) -> list[dict[str, str]]:
    kinds = {"headings": r"(?is)<h[1-6][^>]*>", "paragraphs_": r"(?is)<p[\s>]", "lists": r"(?is)<(?:ul|ol)[\s>]", "tables": r"(?is)<table[\s>]", "links": r"(?is)<a\s", "times": r"\b\d{1,2}:\d{2}\b", "votes": r"(?i)\bvot(?:e|ing)\b", "amendments": r"(?i)\bamendments?\b"}
    return [
        {k: d.count("html", p) for k, p in kinds.items()},
        {"structure_score": "least(1.0D, CASE WHEN headings > 0 THEN 0.3D ELSE 0.0D END + CASE WHEN paragraphs_ > 2 THEN 0.3D ELSE 0.0D END + CASE WHEN lists + tables > 0 THEN 0.2D ELSE 0.0D END + CASE WHEN times + votes > 0 THEN 0.2D ELSE 0.0D END)"},
    ]


def page_metadata(d: Spark) -> list[dict[str, str]]:
    text = d.rep("html", r"<[^>]*>", " ")
    dates = [r"(\d{1,2}\s+\w+\s+\d{4})", r"(\d{4}-\d{2}-\d{2})", r"(\d{2}/\d{2}/\d{4})"]
    return [
        {"plain": text},
        {
            "title": f"trim({d.ext('html', '(?is)<title[^>]*>([^<]*)</title>', 1)})",
            "page_date": "coalesce(" + ", ".join(f"nullif({d.ext('plain', p, 1)}, '')" for p in dates) + ")",
            "language": case([(f"{d.has('lower(plain)', 'english')} OR {d.has('html', 'en.html')}", "'EN'"), (f"{d.has('lower(plain)', 'français')} OR {d.has('html', 'fr.html')}", "'FR'"), (f"{d.has('lower(plain)', 'deutsch')} OR {d.has('html', 'de.html')}", "'DE'")]),
            "total_length": "cast(length(html) as bigint)",
        },
    ]


def report_validity(d: Spark) -> list[dict[str, str]]:
    found = " + ".join(f"CASE WHEN {d.has('lower(plain)', w)} THEN 1 ELSE 0 END" for w in R.REPORT_WORDS)
    return [{"plain": d.rep("html", r"<[^>]*>", " ")}, {"is_report": f"length(html) >= 100 AND ({found}) >= 2"}]


def content_kind(d: Spark) -> list[dict[str, str]]:
    low, kinds = "lower(text)", [
        ("verbatim_transcript", ["madam president", "mr president", "honourable members", "sitting is open"]),
        ("committee_minutes", ["committee", "rapporteur", "opinion", "draft report"]),
        ("amendment_text", ["amendment", "amend", "proposal for"]),
        ("voting_record", ["voting", "vote", "ballot", "in favour", "against", "abstentions"]),
    ]
    return [{"kind": case([("(" + " OR ".join(d.has(low, w) for w in ws) + ")", f"'{k}'") for k, ws in kinds], "'unknown'")}]


def preprocessed(d: Spark) -> list[dict[str, str]]:
    clean = d.rep(d.rep(d.rep("text", r"<[^>]*>"), r"\s+", " "), r"^\s+|\s+$")
    verbatim = d.rep(d.rep(clean, r"(?i)\((?:applause|laughter|interruption)\)"), r"(?m)^\s*[-–—]\s*")
    minutes = d.rep(d.rep(clean, r"\[.*?\]"), r"(?m)^\s*\d+\.\s*")
    return [*content_kind(d), {"clean": f"CASE kind WHEN 'verbatim_transcript' THEN {verbatim} WHEN 'committee_minutes' THEN {minutes} ELSE {clean} END"}, {"n_clean": "cast(length(clean) as bigint)"}]


def processing_quality(d: Spark) -> list[dict[str, str]]:
    return [
        *Q.structural(d), *Q.linguistic(d),
        {"processing": "least(1.0D, CASE WHEN n_words > 100 THEN 0.2D WHEN n_words > 20 THEN 0.1D ELSE 0.0D END + 0.2D * language_share + 0.3D * document_structure + 0.2D * speaker_structure)"},
        {"processing_level": case([("processing >= 0.8D", "'excellent'"), ("processing >= 0.6D", "'good'"), ("processing >= 0.4D", "'fair'"), ("processing >= 0.2D", "'poor'")], "'failed'")},
    ]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def w23_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).withColumn("ok", F.col("event_type") != "error").withColumn("service", F.pmod("user_id", F.lit(7)))
    return S.breaker_states(e, "service", "ts", "event_id", "ok", failures=3, wait=3600.0)


def w23b_breaker_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).withColumn("ok", F.col("event_type") != "error").withColumn("service", F.pmod("user_id", F.lit(7)))
    return S.breaker_states(e, "service", "ts", "event_id", "ok", failures=3, wait=3600.0, close_at_once=True)


def r1_windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stream.windowed_counts(_events(spark, sf_dir))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", "failed")


R1_SQL = """SELECT s AS start, event_type, count(*) AS n, count(*) FILTER (event_type = 'error') AS failed FROM (
  SELECT event_type, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS s FROM events) GROUP BY ALL"""


def j8_resolved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names typed for each supplier, exact or with a letter more, fewer, swapped or many wrong, against all customers;
    people have names of two words, drawn from their key's digest."""
    word = lambda key, a, n: F.initcap(F.translate(F.substring(F.md5(F.col(key).cast("string")), a, n), "0123456789abcdef", "aeioubcdfglmnrst"))
    full = lambda key: F.concat(word(key, 1, 6), F.lit(" "), word(key, 7, 8))
    members = spark.read.parquet(f"{sf_dir}/customer.parquet").select(full("c_custkey").alias("member"))
    own, k = F.col("own"), F.col("s_suppkey") % 6
    typed = (
        F.when(k == 0, own).when(k == 1, F.concat(own, F.lit("a"))).when(k == 2, F.substring(own, 2, 40)).when(k == 3, F.concat_ws(" ", F.substring_index(own, " ", -1), F.substring_index(own, " ", 1)))
        .when(k == 4, F.concat(F.lit("X"), F.substring(own, 2, 40))).otherwise(F.reverse(own))
    )
    names = spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumn("own", full("s_suppkey")).select(typed.alias("name"))
    return S.resolved_names(names, members)


def t2_normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.concat(F.element_at(F.array(*map(F.lit, ["Mr ", "President ", "Dr. ", ""])), (F.col("c_custkey") % 4 + 1).cast("int")), "c_name", F.lit(" (GRP)")).alias("name"))
    return S.normalized_names(names, "name").select("c_custkey", "plain_name")


T2_SQL = r"SELECT c_custkey, trim(regexp_replace(regexp_replace(c_name, '[^A-Za-z0-9_\s''-]', ' ', 'g'), '\s+', ' ', 'g')) AS plain_name FROM customer"


def a15_timeline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.plans.transcript_queries import w5_interpolated

    t = w5_interpolated(spark, sf_dir).withColumn("gap", F.expr("start - lag(end) OVER (PARTITION BY session_id ORDER BY seq)"))
    return t.groupBy("session_id").agg(F.count("*").alias("n"), F.round(F.avg(F.expr("end - start")), 6).alias("mean_s"), F.max(F.expr("end - start")).alias("max_s"), F.round(F.sum(F.expr("CASE WHEN gap > 60 THEN gap / 60 ELSE 0.0D END")), 6).alias("break_minutes"))


def _a15_sql() -> str:
    from lectern.plans.transcript_queries import W5_SQL

    return f"""SELECT session_id, count(*) AS n, round(avg("end" - start), 6) AS mean_s, max("end" - start) AS max_s, round(sum(CASE WHEN gap > 60 THEN gap / 60 ELSE 0.0::DOUBLE END), 6) AS break_minutes
    FROM (SELECT *, start - lag("end") OVER (PARTITION BY session_id ORDER BY seq) AS gap FROM ({W5_SQL})) GROUP BY session_id"""


PAIRS = {
    "t22_structural_quality": _documents(Q.structural, _rounded("document_structure", "speaker_structure", "formatting", "segmentation", "structural")),
    "t23_content_quality": _documents(lambda d: [*Q.structural(d), *Q.content(d)], _rounded("completeness", "coherence", "depth", "relevance", "content")),
    "t24_linguistic_quality": _documents(_repeated, ["detected", *_rounded("consistency", "readability", "grammar", "vocabulary", "linguistic")]),
    "t25_metadata_quality": _documents(Q.assessed, _rounded("metadata")),
    "t26_overall_quality": _documents(Q.assessed, ["level", *_rounded("score")]),
    "t27_quality_rules": _documents(Q.assessed, ["rules"]),
    "t28_quality_indicators": _documents(Q.assessed, ["production_ready", "needs_review", *_rounded("potential")]),
    "t29_language_vote": _documents(_repeated, ["detected", *_rounded("language_share")]),
    "t31_structure_counts": _pages(structure_counts, ["headings", "paragraphs_", "lists", "tables", "links", "times", "votes", "amendments", "structure_score"]),
    "t32_content_kind": _documents(content_kind, ["kind"]),
    "t33_preprocessing": _documents(preprocessed, ["kind", "n_clean"]),
    "t35_processing_quality": _documents(processing_quality, ["processing_level", *_rounded("processing")]),
    "s16_page_metadata": _pages(page_metadata, ["title", "page_date", "language", "total_length"]),
    "s17_report_validity": _pages(report_validity, ["is_report"], _REPORTS),
    "a15_timeline_stats": (a15_timeline_stats, _a15_sql()),
    "r1_windowed_counts": (r1_windowed_counts, R1_SQL),
    "t2_normalized_names": (t2_normalized_names, T2_SQL),
    "f1_content_elements": (lambda spark, sf_dir: P.content_elements(pages(spark, sf_dir)), None),
    "t1_clean_html": (lambda spark, sf_dir: P.cleaned(pages(spark, sf_dir)), None),
    "j8_resolved_names": (j8_resolved_names, None),
    "w23_breaker": (w23_breaker, None),
    "w23b_breaker_variant": (w23b_breaker_variant, None),
}
