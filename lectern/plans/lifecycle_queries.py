"""Queries of the operators on logs, caches, addresses and landed answers, each with SQL written by itself.

The tables hold no such records, so a base statement (the same text for both engines) lays them over events, parts and
pages: it makes inputs only, never a rule's outcome.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.operators import lifecycle as L
from lectern.plans.relational_queries import TABLES
from lectern.sources.segments import SEGMENTS_SQL, segments


def base(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [t for t in TABLES if "{" + t + "}" in sql]
    sql = sql.replace("{", "{{").replace("}", "}}")  # braces of JSON stand for themselves
    for t in used:
        sql = sql.replace("{{" + t + "}}", "{" + t + "}")
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def duck(sql: str) -> str:
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql


def bound(source: str, apply: Callable[[DataFrame], DataFrame], sql: str, spark_source: str | None = None):
    """(query, SQL) of an operator on a base statement; sql reads the base as `b`."""
    return (lambda spark, sf_dir: apply(base(spark, sf_dir, spark_source or source))), f"WITH b AS ({duck(source)}) {sql}"


def sql_list(values) -> str:
    return ", ".join("'" + str(v) + "'" for v in values)


ERRORS = """SELECT event_id AS id, event_id * 13 % 100000 AS sec, CAST(event_id % 5 AS int) AS retries, event_id % 7 = 0 AS resolved,
  CASE event_id % 13 WHEN 0 THEN 'ConnectionError' WHEN 1 THEN 'TimeoutError' WHEN 2 THEN 'RateLimitError' WHEN 3 THEN 'MemoryError'
    WHEN 4 THEN 'TokenExpiredError' WHEN 5 THEN 'AuthenticationError' WHEN 6 THEN 'DataCorruptionError' WHEN 7 THEN 'DiskSpaceError' ELSE 'OtherError' END AS type,
  CASE event_id % 11 WHEN 0 THEN 'Rate limit reached' WHEN 1 THEN 'Connection reset: authentication' WHEN 2 THEN 'permission denied'
    WHEN 3 THEN 'Authentication failed' WHEN 4 THEN 'read TIMEOUT' WHEN 5 THEN NULL ELSE 'strange' END AS message FROM {events}"""


def _rule(values) -> str:
    severity, category, strategy, retries, factor = values
    return f"{{'severity': '{severity}', 'category': '{category}', 'strategy': '{strategy}', 'max_retries': {retries}, 'factor': {factor}::DOUBLE}}"


CLASSED = (
    "c AS (SELECT * EXCLUDE (r), CASE WHEN retries > 2 AND r.severity = 'low' THEN 'medium' WHEN retries > 2 AND r.severity = 'medium' THEN 'high' ELSE r.severity END AS severity,"
    " r.category AS category, r.strategy AS strategy, r.max_retries AS max_retries, r.factor AS factor FROM (SELECT *, CASE "
    + " ".join(f"WHEN type = '{t}' THEN {_rule(v)}" for t, v in R.ERROR_TYPES.items())
    + " "
    + " ".join(f"WHEN coalesce(message, '') ILIKE '%{m}%' THEN {_rule(v)}" for m, v in R.ERROR_MESSAGES)
    + f" ELSE {_rule(R.ERROR_DEFAULT)} END AS r FROM b))"
)

STATES = """SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'discovered' WHEN 'click' THEN 'queued' WHEN 'purchase' THEN 'processing'
  WHEN 'signup' THEN 'completed' ELSE 'retry_pending' END AS state, CAST(value AS double) AS value, event_type = 'purchase' AS is_set,
  CASE user_id % 8 WHEN 0 THEN 'session_discovery' WHEN 1 THEN 'integration_results' WHEN 2 THEN 'document_links' WHEN 3 THEN 'verbatim_content'
    WHEN 4 THEN 'parsed_speeches' WHEN 5 THEN 'validation_results' WHEN 6 THEN 'api_responses' ELSE 'notes' END AS kind,
  event_type AS service, CAST(event_id * 37 AS double) AS sec FROM {events}"""

CACHE = """SELECT p_partkey AS key, CASE p_partkey % 8 WHEN 0 THEN 'session_discovery' WHEN 1 THEN 'integration_results' WHEN 2 THEN 'document_links'
    WHEN 3 THEN 'verbatim_content' WHEN 4 THEN 'parsed_speeches' WHEN 5 THEN 'validation_results' WHEN 6 THEN 'api_responses' ELSE 'notes' END AS kind,
  CAST(p_partkey % 997 * 800 AS double) AS created, CAST(p_partkey % 997 * 800 + p_size * 600 AS double) AS accessed, 800000.0E0 AS now,
  md5(p_name) AS hash, CASE WHEN p_partkey % 6 = 0 THEN md5(p_brand) WHEN p_partkey % 6 = 1 THEN NULL ELSE md5(p_name) END AS current_hash,
  CAST(p_size % 4 AS bigint) AS uses FROM {part}"""

HOST = "https://www.europarl.europa.eu/"
URLS = f"""SELECT page_id, CASE page_id % 14 WHEN 0 THEN '{HOST}doceo/document/CRE-9-2024-EN.html' WHEN 1 THEN '{HOST}doceo/document/CRE-9-2024-FR.pdf'
    WHEN 2 THEN '{HOST}plenary/en/vod/x.html' WHEN 3 THEN '{HOST}doceo/document/OJ-9-2024-EN-AG.html' WHEN 4 THEN '{HOST}plenary/de/agenda/today'
    WHEN 5 THEN '{HOST}doceo/document/PV-9-2024-EN-PV.html?x=1' WHEN 6 THEN 'https://example.org/fr/Amendment_list-12.xml'
    WHEN 7 THEN 'https://example.org/a/written-question.doc#top' WHEN 8 THEN 'http://example.org/EN/resolution.v2.docx' WHEN 9 THEN 'https://example.org/report/'
    ELSE url END AS url FROM {{pages}}"""

SESSIONS = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'PV-9-2024-01-02' WHEN 1 THEN '9-2024' WHEN 2 THEN 'CRE-10-2023-11-30-x' WHEN 3 THEN '2021-05-06'
  ELSE 'plain' END AS name FROM {orders}"""

SPEAKERS = """SELECT c_custkey, CASE c_custkey % 11 WHEN 0 THEN 'Madam PRESIDENT' WHEN 1 THEN 'commissioner anna BELL' WHEN 2 THEN '<b>maria  de souza</b> (EPP)'
    WHEN 3 THEN 'jan novak, rapporteur' WHEN 4 THEN 'Mr john SMITH MEP' WHEN 5 THEN ' x' WHEN 6 THEN 'DR ada – lovelace' WHEN 7 THEN NULL
    WHEN 8 THEN 'prof o''hara-jones' ELSE c_name END AS raw FROM {customer}"""

SPEECHES = """SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN concat('President. ', text) WHEN 1 THEN concat('Anna  Bell – ', text) WHEN 2 THEN concat('Jan Novak — short ', role)
  ELSE text END AS text FROM {conversations}"""

ANSWERS = """SELECT o_orderkey AS answer, CASE o_orderkey % 4 WHEN 0 THEN '{"results": [{"id": "a", "date": "2024-01-02", "end": null}, {"id": "b", "title": "T"}], "n": 2}'
  WHEN 1 THEN '[{"id": "c", "end": "2020-01-01"}]' WHEN 2 THEN '{"error": "none"}' ELSE concat('{"results": [{"id": "', CAST(o_orderkey AS varchar(20)), '", "title": "x y"}]}') END AS body FROM {orders}"""

BINDINGS = """SELECT n_nationkey, concat('{"results": {"bindings": [{"doc": {"type": "uri", "value": "http://x/', n_name, '"}, "date": {"value": "2024"}}, {"doc": {"value": "z"}}]}}') AS body FROM {nation}"""

TRIPLES = """SELECT url AS s, 'http://x.org/p#title' AS p, concat('t', CAST(page_id % 9 AS varchar(9))) AS o, page_id * 8 AS k FROM {pages}
  UNION ALL SELECT url, 'http://x.org/terms/date', CAST(page_id AS varchar(9)), page_id * 8 + 1 FROM {pages} WHERE page_id % 3 = 0
  UNION ALL SELECT url, 'http://y.org/terms#title', concat('a', CAST(page_id % 7 AS varchar(9))), page_id * 8 + 2 + page_id % 2 FROM {pages} WHERE page_id % 5 = 0
  UNION ALL SELECT url, 'http://x.org/p#a/date', 'no', page_id * 8 + 4 FROM {pages} UNION ALL SELECT url, 'other', 'n', page_id * 8 + 5 FROM {pages}"""


def _likes(words, column="lower(url)") -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


KIND = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(url, '{p}') THEN '{k}'" for k, p in R.URL_PATTERNS)
    + " "
    + " ".join(f"WHEN {_likes(w)} THEN '{k}'" for k, w in R.URL_WORDS)
    + " ELSE 'other' END"
)
TITLE = "list_aggregate(list_transform(string_split({0}, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), 'string_agg', ' ')"
NAME = (
    "CASE WHEN length(trim(coalesce(raw, ''))) < 2 THEN '' WHEN regexp_matches(clean, '{president}') THEN 'President' {arms} "
    "WHEN plain <> '' THEN {title} ELSE trim(raw) END"
).format(
    president=R.PRESIDENT,
    arms=" ".join(f"WHEN regexp_matches(clean, '{p}') THEN '{x}' || " + TITLE.format(f"trim(regexp_extract(clean, '{p}', 1))") for x, p in R.NAMED_SPEAKERS),
    title=TITLE.format("regexp_replace(plain, '\\s+', ' ', 'g')"),
)
CLEAN = r"replace(replace(trim(regexp_replace(regexp_replace(raw, '<[^>]+>', '', 'g'), '\s+', ' ', 'g')), '–', '-'), '—', '-')"
PLAIN = "clean"
for _p in R.SPEAKER_TITLES:
    PLAIN = f"trim(regexp_replace({PLAIN}, '{_p}', '', 'g'))"

_LEGAL = sql_list(f"{a}>{b}" for a, to in R.TRANSITIONS.items() for b in to)
_HOURS = "CASE kind " + " ".join(f"WHEN '{k}' THEN {h}" for k, h in R.CACHE_HOURS.items()) + f" ELSE {R.OTHER_HOURS} END"
RESULT = "id string, date string, title string, `end` string"


def _report_base(df: DataFrame) -> DataFrame:
    # Where a score ends in a five, the order in which doubles are summed tells its last digit: it is that of the events.
    order = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = df.withColumn("v", F.sum("value").over(order))
    counts = summed.groupBy("user_id", "service").agg(F.count("*").alias("k"), F.count_if(F.col("value") < 20).alias("low"), F.max(F.struct("event_id", "v")).alias("last"))
    by = counts.groupBy("user_id").agg(
        F.sum("k").alias("n"),
        F.sum(F.when(F.col("service") == "error", F.col("k")).otherwise(0)).alias("failed"),
        F.sum("low").alias("warned"),
        (F.max("last")["v"] / F.sum("k") / 1000).alias("score"),
        F.map_from_entries(F.collect_list(F.struct("service", "k"))).alias("severities"),
    )
    return by.withColumn("passed", F.col("n") - F.col("failed"))


def _restored(df: DataFrame) -> DataFrame:
    checkpoint = df.where("key % 3 <> 0").select("key", F.when(F.col("uses") > 1, "completed").otherwise("pending").alias("status"), F.lit("checkpoint").alias("origin"))
    current = df.where("key % 3 <> 1").select("key", F.lit("running").alias("status"), F.lit("current").alias("origin"))
    modes = [L.restored(checkpoint, current, "key", m).withColumn("mode", F.lit(m)) for m in ("full", "partial", "merge")]
    return modes[0].unionByName(modes[1]).unionByName(modes[2])


def _parts(df: DataFrame) -> DataFrame:
    return L.url_parts(df, "url").select("page_id", L.url_kind("url").alias("kind"), "language", "format", "title")


def _eviction(df: DataFrame) -> DataFrame:
    whole = df.agg(F.sum("p_size").alias("total"))
    told = L.running_total(df, "p_size", ["p_retailprice", "p_partkey"]).crossJoin(F.broadcast(whole))
    return told.where(F.col("total") - (F.col("upto") - F.col("p_size")) > F.col("total") * 0.5).select("p_partkey")


def _members(df: DataFrame) -> DataFrame:
    names = df.where("kind = 'name'").select("id", "name")
    return L.contains_join(names, "name", df.where("kind = 'needle'").select(F.col("id").alias("needle_id"), F.col("name").alias("needle")), "needle")


NAMES = """SELECT 'name' AS kind, c_custkey AS id, c_name AS name FROM {customer}
  UNION ALL SELECT 'needle', n_nationkey, concat('R#0000', CASE WHEN n_nationkey < 10 THEN '000' ELSE '00' END, CAST(n_nationkey AS varchar(9))) FROM {nation}
  UNION ALL SELECT 'needle', 100 + r_regionkey, CAST(r_regionkey * 21 AS varchar(9)) FROM {region} UNION ALL SELECT 'needle', 200 + r_regionkey, '00014' FROM {region} WHERE r_regionkey < 2"""


_SCORES = ", ".join(
    "least(1.0, least(0.5, len(list_filter([" + sql_list(patterns) + "], lambda p: regexp_matches(lower(text), p)))::DOUBLE * 0.2::DOUBLE)"
    + (" + CASE WHEN " + _likes(roles, "lower(speaker)") + " THEN 0.3::DOUBLE ELSE 0 END" if roles else "")
    + f" + CASE WHEN n < {short} THEN 0.2::DOUBLE ELSE 0 END"
    + (" + least(0.3, len(list_filter([" + sql_list(context) + "], lambda w: contains(lower(text), w)))::DOUBLE * 0.1::DOUBLE)" if context else "")
    + f")::DOUBLE AS {name}"
    for name, (patterns, roles, context, short) in R.ANNOUNCEMENT_RULES.items()
)



def _failing(df: DataFrame) -> DataFrame:
    """Errors with the attempt that would succeed, and what a degraded service or a cache could give."""
    return df.withColumns({"at_": F.expr("CASE WHEN id % 3 > 0 THEN CAST(id % 6 AS int) END"), "degraded": F.expr("CASE WHEN id % 4 = 0 THEN concat('d', id) END"), "cached": F.expr("CASE WHEN id % 5 < 3 THEN concat('c', id) END")})


def _recovered(df: DataFrame) -> DataFrame:
    return L.recovered(L.classified_errors(_failing(df)), "at_", "degraded", "cached")


_ACTED = """a AS (SELECT *, CASE WHEN id % 3 > 0 THEN (id % 6)::INT END AS at_, CASE WHEN strategy = 'manual_intervention' THEN 'raise' WHEN retries >= max_retries THEN 'give_up'
  WHEN strategy = 'checkpoint_restore' THEN 'restore' WHEN strategy = 'graceful_degradation' THEN 'degrade' ELSE 'retry' END AS action FROM c)"""
_RESOLVED = """e AS (SELECT * EXCLUDE (resolved), CASE WHEN action = 'degrade' THEN CASE WHEN id % 4 = 0 THEN 'd' || id WHEN id % 5 < 3 THEN 'c' || id END END AS value,
  CASE WHEN action = 'retry' THEN greatest(least(max_retries, coalesce(at_, max_retries)) - retries, 0) ELSE 0 END::BIGINT AS attempts,
  CASE WHEN action = 'retry' AND at_ > retries AND at_ <= max_retries THEN 1 ELSE 0 END::BIGINT AS successes FROM a),
d AS (SELECT *, successes > 0 OR value IS NOT NULL AS resolved FROM e)"""


PAIRS = {
    "t39_error_class": bound(ERRORS, lambda b: L.classified_errors(b).select("id", "severity", "category", "strategy", "max_retries", "factor"), f", {CLASSED} SELECT id, severity, category, strategy, max_retries, factor FROM c"),
    "r13_recovery_plan": bound(
        ERRORS,
        lambda b: L.recovery_plan(L.classified_errors(b)).select("id", "action", F.round("delay", 6).alias("delay")),
        f""", {CLASSED}, a AS (SELECT *, CASE WHEN strategy = 'manual_intervention' THEN 'raise' WHEN retries >= max_retries THEN 'give_up' WHEN strategy = 'checkpoint_restore' THEN 'restore'
        WHEN strategy = 'graceful_degradation' THEN 'degrade' ELSE 'retry' END AS action FROM c)
        SELECT id, action, CASE WHEN action = 'retry' THEN round(least(300.0, CASE strategy WHEN 'immediate_retry' THEN 0.0 WHEN 'linear_backoff' THEN 5 * factor * (retries + 1) ELSE 5 * pow(factor, retries) END)::DOUBLE, 6) END AS delay FROM a""",
    ),
    "r13_recovery_attempts": bound(
        ERRORS,
        lambda b: L.recovery_attempts(L.classified_errors(_failing(b)), "at_").select("id", "attempt", F.round("delay", 6).alias("delay"), "success"),
        f""", {CLASSED}, {_ACTED}, t AS (SELECT *, unnest(range(retries + 1, least(max_retries, coalesce(at_, max_retries)) + 1)) AS attempt FROM a WHERE action = 'retry')
        SELECT id, attempt::INT AS attempt, round(least(300.0, CASE strategy WHEN 'immediate_retry' THEN 0.0 WHEN 'linear_backoff' THEN 5 * factor * attempt ELSE 5 * pow(factor, attempt - 1) END)::DOUBLE, 6) AS delay,
        coalesce(attempt = at_, false) AS success FROM t""",
    ),
    "r13_recovered": bound(
        ERRORS,
        lambda b: _recovered(b).select("id", "action", "value", "resolved", "attempts", "successes"),
        f", {CLASSED}, {_ACTED}, {_RESOLVED} SELECT id, action, value, resolved, attempts, successes FROM d",
    ),
    "a11_error_stats": bound(
        ERRORS,
        lambda b: L.error_statistics(_recovered(b)).withColumn("rate", F.round("rate", 9)),
        f""", {CLASSED}, {_ACTED}, {_RESOLVED}, u AS (SELECT * FROM d, unnest(['all', 'severity', 'category', 'strategy']) AS x(g))
        SELECT g AS "by", CASE g WHEN 'severity' THEN severity WHEN 'category' THEN category WHEN 'strategy' THEN strategy ELSE '' END AS name, count(*) AS n, count(*) FILTER (resolved) AS resolved,
        round(count(*) FILTER (resolved) / count(*), 9) AS rate, sum(attempts)::BIGINT AS attempts, sum(successes)::BIGINT AS successes FROM u GROUP BY ALL""",
    ),
    "r16_background_recovery": bound(
        ERRORS,
        lambda b: L.background_recovery(L.classified_errors(b), "sec").select("id", "outcome"),
        f""", {CLASSED}, l AS (SELECT * FROM c WHERE severity IN ('low', 'medium') AND NOT resolved ORDER BY sec DESC, id DESC LIMIT 10)
        SELECT id, CASE WHEN category = 'rate_limit' THEN 'resolved' ELSE 'retry' END AS outcome FROM l WHERE retries < 3
        AND strategy IN ('linear_backoff', 'exponential_backoff', 'graceful_degradation')""",
    ),
    "r10_illegal_transitions": bound(
        STATES,
        lambda b: L.illegal_transitions(b, "user_id", ["sec", "event_id"], "state").select("event_id", "before", "state"),
        f"SELECT event_id, before, state FROM (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS before FROM b) WHERE before <> state AND before || '>' || state NOT IN ({_LEGAL})",
    ),
    "r12_cache_hits": bound(
        STATES,
        lambda b: L.cache_hits(b, "user_id", "kind", "sec", ["sec", "event_id"], "is_set"),
        f"""SELECT kind, count(*) FILTER (NOT is_set AND coalesce(sec - s <= 3600 * {_HOURS}, false)) AS hits, count(*) FILTER (NOT is_set AND NOT coalesce(sec - s <= 3600 * {_HOURS}, false)) AS misses,
        count(*) FILTER (is_set) AS sets FROM (SELECT *, max(CASE WHEN is_set THEN sec END) OVER (PARTITION BY user_id, kind ORDER BY sec, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM b) GROUP BY kind""",
    ),
    "r4_cache_validity": bound(
        CACHE,
        lambda b: L.stale_entries(b, "kind", "created", "accessed", F.col("now"), "hash", "current_hash", "uses", F.lit(True)).select("key", "reason"),
        f"""SELECT key, reason FROM (SELECT key, CASE WHEN (now - created) / 3600 > {_HOURS} THEN 'time' WHEN (now - created) / 3600 > 168 THEN 'age' WHEN current_hash <> hash THEN 'content'
        WHEN uses <= 0 OR (now - accessed) / 3600 > 72 THEN 'size' END AS reason FROM b) WHERE reason IS NOT NULL""",
    ),
    "r6_restored": bound(
        CACHE,
        _restored,
        """, k AS (SELECT key, CASE WHEN uses > 1 THEN 'completed' ELSE 'pending' END AS status, 'checkpoint' AS origin FROM b WHERE key % 3 <> 0)
        SELECT *, 'full' AS mode FROM k UNION ALL SELECT *, 'partial' FROM k WHERE status = 'completed' UNION ALL SELECT *, 'merge' FROM k
        UNION ALL SELECT key, 'running', 'current', 'merge' FROM b WHERE key % 3 = 0""",
    ),
    "r2_quality_alerts": bound(
        STATES,
        lambda b: L.trailing_alerts(b, "service", "sec", "event_id", "value", 20000.0, 100, 50.0),
        """, r AS (SELECT service, value, row_number() OVER (PARTITION BY service ORDER BY sec DESC, event_id DESC) AS k FROM b WHERE sec > (SELECT max(sec) FROM b) - 20000)
        SELECT service, round(avg(value), 6) AS mean, count(*) AS n, avg(value) < 50 AS alert FROM r WHERE k <= 100 GROUP BY service""",
    ),
    "w19_recent_rate": bound(
        STATES,
        lambda b: L.recent_rates(b, "user_id", "sec", "event_id", "value").select("user_id", F.round("rate", 9).alias("rate")),
        """, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sec DESC, event_id DESC) AS k FROM b)
        SELECT user_id, round(CASE WHEN max(sec) > min(sec) THEN (arg_min(value, k) - arg_max(value, k)) / (max(sec) - min(sec)) ELSE 0 END, 9) AS rate FROM r WHERE k <= 5 GROUP BY user_id""",
    ),
    "r8_integrity": bound(
        "SELECT doc_id, text, CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS off, CASE WHEN doc_id % 7 = 0 THEN 'x' ELSE '' END AS more FROM {documents} WHERE text IS NOT NULL",
        lambda b: L.integrity_errors(b.withColumn("size", F.octet_length("text") + F.col("off")).withColumn("sha", F.sha2(F.concat("text", "more"), 256)), "text", "size", "sha").select("doc_id", "errors"),
        "SELECT doc_id, concat_ws('; ', CASE WHEN off = 1 THEN 'size' END, CASE WHEN more = 'x' THEN 'hash' END) AS errors FROM b",
    ),
    "t36_url_type": bound(URLS, lambda b: b.select("page_id", L.url_kind("url").alias("kind")), f"SELECT page_id, {KIND} AS kind FROM b"),
    "t37_url_parts": bound(
        URLS,
        _parts,
        rf""", p AS (SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM b), q AS (SELECT *, string_split(path, '/') AS parts, lower(string_split(path, '.')[-1]) AS ext FROM p)
        SELECT page_id, {KIND} AS kind, upper(list_filter(parts, lambda x: regexp_matches(x, '^\pL\pL$'))[1]) AS language, CASE WHEN contains(path, '.') AND ext IN ({sql_list(R.URL_FORMATS)}) THEN ext END AS format,
        CASE WHEN parts[-1] <> '' THEN {TITLE.format("translate(string_split(parts[-1], '.')[1], '-_', '  ')")} END AS title FROM q""",
    ),
    "t38_session_id_parts": bound(
        SESSIONS,
        lambda b: b.select("o_orderkey", *[c.alias(n) for n, c in L.session_name("name").items()]),
        """SELECT o_orderkey, nullif(split_part(name, '-', 1), name) AS type, split_part(name, '-', 2) AS term, split_part(name, '-', 3) AS year, split_part(name, '-', 4) AS month, split_part(name, '-', 5) AS day, NULL AS session, NULL AS id FROM b WHERE name[1:1] IN ('P', 'C')
        UNION ALL SELECT o_orderkey, NULL, NULL, '2021', '05', '06', NULL, NULL FROM b WHERE name = '2021-05-06' UNION ALL SELECT o_orderkey, NULL, '9', NULL, NULL, NULL, '2024', NULL FROM b WHERE name = '9-2024'
        UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL, name FROM b WHERE name = 'plain'""",
    ),
    "t30_normalized_speakers": bound(SPEAKERS, lambda b: b.select("c_custkey", L.normalized_speaker("raw").alias("name")), f", c AS (SELECT *, {CLEAN} AS clean FROM b), p AS (SELECT *, {PLAIN} AS plain FROM c) SELECT c_custkey, {NAME} AS name FROM p"),
    "t34_speaker_paragraphs": bound(
        SPEECHES,
        lambda b: L.speaker_paragraphs(b, "text").drop("text"),
        rf""", f AS (SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM b), s AS (SELECT conv_id, turn, trim(regexp_extract(t, '{R.SPEECH_START}', 1)) AS speaker,
        trim(regexp_extract(t, '{R.SPEECH_START}', 2)) AS speech FROM f WHERE length(t) >= 10 AND regexp_matches(t, '{R.SPEECH_START}'))
        SELECT *, speaker <> '' AS has_speaker, length(speech) >= 10 AS long_enough, contains(speech, '.') OR contains(speech, '?') AS proper FROM s""",
    ),
    "t43_validation_report": bound(
        STATES,
        lambda b: L.validation_report(_report_base(b), "user_id"),
        """, c AS (SELECT user_id, service, count(*) AS k FROM b GROUP BY ALL), l AS (SELECT user_id, string_agg('  ' || upper(service) || ': ' || k, chr(10) ORDER BY service) AS t FROM c GROUP BY user_id),
        s AS (SELECT user_id, count(*) AS n, count(*) FILTER (service = 'error') AS failed, count(*) FILTER (value < 20) AS warned, sum(value) / count(*) / 1000 AS score FROM b GROUP BY user_id)
        SELECT user_id, 'SUMMARY:' || chr(10) || '  Overall Status: ' || CASE WHEN failed = 0 THEN 'PASS' ELSE 'FAIL' END || chr(10) || '  Quality Score: ' || format('{:.3f}', score) || chr(10) || '  Total Segments: ' || n || chr(10) ||
        '  Passed: ' || (n - failed) || chr(10) || '  With Warnings: ' || warned || chr(10) || '  With Errors: ' || failed || chr(10) || chr(10) || 'ISSUES BY SEVERITY:' || chr(10) || t AS report FROM s JOIN l USING (user_id)""",
    ),
    "s1_landed_results": bound(
        ANSWERS,
        lambda b: L.unwrapped(b, "body", RESULT).withColumnRenamed("end", "until"),
        """, r AS (SELECT answer, unnest(CAST(CASE WHEN body[1:1] = '[' THEN body ELSE json_extract(body, '$.results') END AS JSON[])) AS x FROM b)
        SELECT answer, x->>'$.id' AS id, x->>'$.date' AS date, x->>'$.title' AS title, x->>'$.end' AS until FROM r""",
    ),
    "s2_active_members": bound(
        ANSWERS,
        lambda b: L.unwrapped(b, "body", RESULT).where(F.col("end").isNull() | (F.col("end") > "2024-01-01")).select("answer", "id"),
        """, r AS (SELECT answer, unnest(CAST(CASE WHEN body[1:1] = '[' THEN body ELSE json_extract(body, '$.results') END AS JSON[])) AS x FROM b)
        SELECT answer, x->>'$.id' AS id FROM r WHERE coalesce(x->>'$.end', '9') > '2024-01-01'""",
    ),
    "s4_binding_flatten": bound(BINDINGS, lambda b: L.bindings(b, "body", ["doc", "date"]), ", r AS (SELECT n_nationkey, unnest(CAST(json_extract(body, '$.results.bindings') AS JSON[])) AS x FROM b) SELECT n_nationkey, x->>'$.doc.value' AS doc, x->>'$.date.value' AS date FROM r"),
    "s6_property_pivot": bound(TRIPLES, lambda b: L.property_pivot(b, "s", "p", "o", ["title", "date"], "k"), "SELECT s, arg_max(o, k) FILTER (p LIKE '%#title') AS title, arg_max(o, k) FILTER (p LIKE '%/date' AND p NOT LIKE '%#%') AS date FROM b GROUP BY s"),
    "k3_lru_eviction": bound(
        "SELECT p_partkey, p_size, p_retailprice FROM {part}",
        _eviction,
        "SELECT p_partkey FROM (SELECT p_partkey, sum(p_size) OVER (ORDER BY p_retailprice, p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - p_size AS gone, sum(p_size) OVER () AS total FROM b) WHERE total - gone > total * 0.5",
    ),
    "k6_issue_order": bound(
        "SELECT doc_id, CASE WHEN n_chars < 300 THEN 'low' WHEN n_chars < 900 THEN 'critical' WHEN n_chars < 3000 THEN 'medium' ELSE 'high' END AS severity, coalesce(lang, 'none') AS category FROM {documents}",
        lambda b: b.orderBy("severity", "category", "doc_id").limit(200),
        "SELECT * FROM b ORDER BY severity, category, doc_id LIMIT 200",
    ),
    "k7_top_suggestions": bound(
        "SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM {documents}",
        lambda b: b.where("k <= 10").groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("first_ids")),
        "SELECT source, array_to_string(list_sort(list(doc_id))[1:10], ',') AS first_ids FROM documents GROUP BY source",
    ),
    "j5_member_search": bound(NAMES, _members, ", n AS (SELECT * FROM b WHERE kind = 'name') SELECT n.id, n.name, m.id AS needle_id, m.name AS needle FROM n JOIN b AS m ON m.kind = 'needle' AND contains(lower(n.name), lower(m.name))"),
    "j6_first_substring": bound(
        NAMES,
        lambda b: _members(b).groupBy("id").agg(F.min("needle_id").alias("first")),
        ", n AS (SELECT * FROM b WHERE kind = 'name') SELECT n.id, min(m.id) AS first FROM n JOIN b AS m ON m.kind = 'needle' AND contains(lower(n.name), lower(m.name)) GROUP BY n.id",
    ),
    "a13_event_counts": bound(
        "SELECT event_type, CASE WHEN value < 20 THEN 'failed' WHEN value < 60 THEN 'running' ELSE 'completed' END AS status FROM {events}",
        lambda b: b.groupingSets([["event_type"], ["status"]], "event_type", "status").agg(F.count("*").alias("n")),
        "SELECT event_type, status, count(*) AS n FROM b GROUP BY GROUPING SETS ((event_type), (status))",
    ),
    "t42_announcement_scores": (
        lambda spark, sf_dir: L.announcement_scores(segments(spark, sf_dir), "text", "speaker").select(
            "session_id", "seq", *[F.round(n, 6).alias(n) for n in (*R.ANNOUNCEMENT_RULES, "confidence")], "is_announcement", "label"
        ),
        rf"""WITH b AS ({SEGMENTS_SQL}), c AS (SELECT *, len(regexp_extract_all(text, '\S+')) AS n FROM b), s AS (SELECT session_id, seq, {_SCORES} FROM c),
        t AS (SELECT *, list_max([session_management, voting_procedure, agenda_item]) AS best FROM s)
        SELECT session_id, seq, round(session_management, 6) AS session_management, round(voting_procedure, 6) AS voting_procedure, round(agenda_item, 6) AS agenda_item,
        round(best, 6) AS confidence, best > 0.6::DOUBLE AS is_announcement, CASE WHEN best > 0.6::DOUBLE THEN
        ['session_management', 'voting_procedure', 'agenda_item'][list_position([session_management, voting_procedure, agenda_item], best)] END AS label FROM t""",
    ),
}
