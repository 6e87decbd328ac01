"""Registered relational queries: filters, joins, aggregations, windows, limits and set operations.

Each is one Spark SQL statement over the tables (Catalyst prunes columns and pushes filters), with its DuckDB twin
where a function differs. Clocks are the largest time in the input, sets are sorted, ties have explicit orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")


def statement(sql: str, duck: str | None = None):
    """(query, oracle) of a statement; {name} stands for a table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        used = [t for t in TABLES if "{" + t + "}" in sql]
        return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})

    other = duck or sql
    for t in TABLES:
        other = other.replace("{" + t + "}", t)
    return run, other


# the session table of the tests: orders as sessions
SESSION = """SELECT o_orderkey AS id, o_custkey AS owner, o_totalprice AS quality, o_orderdate AS created,
  CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'F' THEN 'completed' ELSE 'failed' END AS state,
  CAST(substring(o_orderpriority, 1, 1) AS int) AS priority, CAST(o_orderkey % 4 AS int) AS attempts FROM {orders}"""
# request log: events as requests
REQUEST = "SELECT event_id, ts, event_type AS service, user_id, value AS latency, event_type <> 'error' AS ok FROM {events}"

PAIRS = {
    # ---- filters and predicates
    "f2_session_filter": statement(f"WITH s AS ({SESSION}) SELECT id, state, priority FROM s WHERE state IN ('queued', 'failed') AND priority <= 3 AND created >= DATE '1996-01-01' AND quality >= 1000.0"),
    "f3_basic_validation": statement("SELECT o_orderkey AS id, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderpriority ELSE 'plenary' END AS session_type FROM {orders} WHERE o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL"),
    "f4_quality_threshold": statement(f"WITH s AS ({SESSION}) SELECT owner, avg(quality) AS avg_quality FROM s GROUP BY owner HAVING avg(quality) >= 150000.0"),
    "f7_recent_failures": statement(f"WITH r AS ({REQUEST}), m AS (SELECT max(ts) AS now FROM r) SELECT event_id, service, latency FROM r, m WHERE NOT ok AND ts >= now - INTERVAL '24' HOUR"),
    "f8_history_window": statement(f"WITH r AS ({REQUEST}), m AS (SELECT max(ts) AS now FROM r) SELECT service, count(*) AS n FROM r, m WHERE ts >= now - INTERVAL '72' HOUR GROUP BY service"),
    "f9_error_retention": statement(
        f"""WITH r AS ({REQUEST}), m AS (SELECT max(ts) AS now FROM r), e AS (SELECT *, event_id % 2 = 0 AS resolved FROM r WHERE NOT ok),
        k AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM e, m WHERE NOT (resolved AND ts < now - INTERVAL '7' DAY))
        SELECT event_id, user_id FROM k WHERE n <= 5"""
    ),
    "f10_persisted_errors": statement(f"WITH r AS ({REQUEST}), m AS (SELECT max(ts) AS now FROM r), e AS (SELECT *, CASE WHEN latency > 80 THEN 'critical' WHEN latency > 50 THEN 'high' ELSE 'low' END AS severity FROM r WHERE NOT ok) SELECT event_id, severity FROM e, m WHERE severity IN ('critical', 'high') AND ts >= now - INTERVAL '10' DAY"),
    "f11_cleanup_completed": statement(f"WITH s AS ({SESSION}), m AS (SELECT max(created) AS now FROM s) SELECT id FROM s, m WHERE NOT (state = 'completed' AND created < now - INTERVAL '7' DAY)"),
    "f12_list_checkpoints": statement(f"WITH s AS ({SESSION}) SELECT id, created FROM s WHERE state = 'completed' ORDER BY created DESC, id DESC LIMIT 20"),
    "f13_expired_checkpoints": statement(f"WITH s AS ({SESSION}), m AS (SELECT max(created) AS now FROM s) SELECT id FROM s, m WHERE created + priority * INTERVAL '100' DAY < now"),
    "f14_wildcard_keys": statement("SELECT p_partkey, p_name FROM {part} WHERE p_name LIKE '%ring%' AND p_brand LIKE 'Brand_2%'", "SELECT p_partkey, p_name FROM part WHERE p_name GLOB '*ring*' AND p_brand GLOB 'Brand?2*'"),
    "f15_model_errors": statement(
        "SELECT doc_id, array_join(array_compact(array(CASE WHEN text IS NULL OR length(text) < 500 THEN 'speech_text' END, CASE WHEN n_chars > 20000 THEN 'n_chars' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'lang' END)), ',') AS errors FROM {documents}",
        "SELECT doc_id, concat_ws(',', CASE WHEN text IS NULL OR length(text) < 500 THEN 'speech_text' END, CASE WHEN n_chars > 20000 THEN 'n_chars' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'lang' END) AS errors FROM documents",
    ),
    "f16_serving_members": statement("SELECT c_custkey FROM {customer} WHERE coalesce(try_to_timestamp(CASE WHEN c_custkey % 3 = 0 THEN 'unknown' WHEN c_custkey % 3 = 1 THEN '2030-01-01' END, 'yyyy-MM-dd') > TIMESTAMP '2024-01-01 00:00:00', true)", "SELECT c_custkey FROM customer WHERE coalesce(try_strptime(CASE WHEN c_custkey % 3 = 0 THEN 'unknown' WHEN c_custkey % 3 = 1 THEN '2030-01-01' END, '%Y-%m-%d') > TIMESTAMP '2024-01-01', true)"),
    "f17_should_retry": statement(f"WITH s AS ({SESSION}) SELECT id, attempts < 3 AS should_retry FROM s WHERE state = 'failed'"),
    "f18_member_fields": statement("SELECT c_custkey, coalesce(nullif(c_name, ''), 'unknown') AS full_name, coalesce(n_name, 'N/A') AS country FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey AND n_regionkey < 3"),
    # ---- joins and lookups
    "j1_source_merge": statement(
        """SELECT coalesce(d.doc_id, l.doc_id) AS session_id, max(d.lang) AS lang, array_join(array_sort(collect_set(u)), ',') AS urls FROM {documents} d FULL JOIN {labels} l ON d.doc_id = l.doc_id
        LATERAL VIEW OUTER explode(array_compact(array(concat('a/', d.source), CASE WHEN l.quality = 1 THEN 'b/good' END, CASE WHEN l.toxic = 1 THEN 'b/toxic' END))) AS u GROUP BY coalesce(d.doc_id, l.doc_id)""",
        """SELECT coalesce(d.doc_id, l.doc_id) AS session_id, max(d.lang) AS lang, coalesce(string_agg(DISTINCT u, ',' ORDER BY u), '') AS urls FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id,
        unnest([CASE WHEN d.source IS NOT NULL THEN concat('a/', d.source) END, CASE WHEN l.quality = 1 THEN 'b/good' END, CASE WHEN l.toxic = 1 THEN 'b/toxic' END]) AS x(u) GROUP BY 1""",
    ),
    "j2_session_merge": statement("SELECT coalesce(a.c_custkey, b.s_suppkey) AS session_id, coalesce(nullif(a.c_mktsegment, 'BUILDING'), b.s_name) AS url FROM (SELECT * FROM {customer} WHERE c_custkey % 2 = 0) a FULL JOIN {supplier} b ON a.c_custkey = b.s_suppkey"),
    "j3_left_enrichment": statement("SELECT d.doc_id, d.source, l.quality FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id"),
    "j4_member_by_id": statement("SELECT o_orderkey, c_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey"),
    "j7_role_lookup": statement("SELECT c_custkey, role FROM (SELECT c_custkey, role, row_number() OVER (PARTITION BY c_custkey ORDER BY k) AS n FROM {customer} JOIN (SELECT * FROM VALUES (1, 'AUTO', 'driver'), (2, 'MACH', 'engineer'), (3, 'A', 'other') AS t(k, hint, role)) ON contains(c_mktsegment, hint)) WHERE n = 1", "SELECT c_custkey, role FROM (SELECT c_custkey, role, row_number() OVER (PARTITION BY c_custkey ORDER BY k) AS n FROM customer JOIN (VALUES (1, 'AUTO', 'driver'), (2, 'MACH', 'engineer'), (3, 'A', 'other')) AS t(k, hint, role) ON contains(c_mktsegment, hint)) WHERE n = 1"),
    "j9_institutional_role": statement("SELECT conv_id, turn, CASE WHEN contains(lower(role), 'user') THEN 'president' WHEN contains(lower(role), 'assist') THEN 'commissioner' END AS resolved, CASE WHEN role IN ('user', 'assistant') THEN 0.9 ELSE 0.0 END * 1.0E0 AS confidence FROM {conversations}"),
    "j11_ready_sessions": statement(
        f"""WITH s AS ({SESSION}), e AS (SELECT id, lag(id) OVER (PARTITION BY owner ORDER BY created, id) AS needs, CASE WHEN id % 5 = 0 THEN 'exclusive' ELSE 'prerequisite' END AS kind FROM s)
        SELECT s.id FROM s WHERE state = 'queued' AND NOT EXISTS (SELECT 1 FROM e LEFT JOIN s t ON e.needs = t.id WHERE e.id = s.id AND e.needs IS NOT NULL AND ((e.kind = 'prerequisite' AND coalesce(t.state, '') <> 'completed') OR (e.kind = 'exclusive' AND coalesce(t.state, '') = 'failed')))"""
    ),
    "j12_dependents": statement(f"WITH s AS ({SESSION}), e AS (SELECT id, lag(id) OVER (PARTITION BY owner ORDER BY created, id) AS needs FROM s) SELECT e.id, e.needs FROM e LEFT SEMI JOIN (SELECT id FROM s WHERE state = 'completed') c ON e.needs = c.id", SESSION and f"WITH s AS ({SESSION}), e AS (SELECT id, lag(id) OVER (PARTITION BY owner ORDER BY created, id) AS needs FROM s) SELECT id, needs FROM e WHERE needs IN (SELECT id FROM s WHERE state = 'completed')"),
    "j13_stale_cache": statement("SELECT o_orderkey, bool_or(p_partkey IS NULL OR l_shipdate > o_orderdate + INTERVAL '100' DAY) AS stale FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey LEFT JOIN (SELECT p_partkey FROM {part} WHERE p_partkey % 50 <> 0) p ON l_partkey = p_partkey GROUP BY o_orderkey"),
    "j14_dictionary_member": statement("SELECT c_custkey, c_mktsegment IN ('BUILDING', 'AUTOMOBILE') OR c_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey = 1) AS known FROM {customer}"),
    # ---- aggregations
    "a5_completeness": statement(
        "SELECT field, rate, rate < 0.9 AS incomplete FROM (SELECT avg(CASE WHEN trim(coalesce(text, '')) <> '' THEN 1.0E0 ELSE 0.0E0 END) AS text, avg(CASE WHEN lang <> 'en' THEN 1.0E0 ELSE 0.0E0 END) AS lang, avg(CASE WHEN n_chars > 500 THEN 1.0E0 ELSE 0.0E0 END) AS n_chars FROM {documents}) LATERAL VIEW stack(3, 'text', text, 'lang', lang, 'n_chars', n_chars) AS field, rate",
        "SELECT field, rate, rate < 0.9 AS incomplete FROM (UNPIVOT (SELECT avg(CASE WHEN trim(coalesce(text, '')) <> '' THEN 1.0 ELSE 0.0 END) AS text, avg(CASE WHEN lang <> 'en' THEN 1.0 ELSE 0.0 END) AS lang, avg(CASE WHEN n_chars > 500 THEN 1.0 ELSE 0.0 END) AS n_chars FROM documents) ON text, lang, n_chars INTO NAME field VALUE rate)",
    ),
    "a6_resolution_quality": statement("SELECT source, round(avg(CASE WHEN l.quality IS NOT NULL THEN n_chars / 1000.0E0 END), 6) AS avg_confidence, count(CASE WHEN n_chars > 2000 AND l.quality IS NOT NULL THEN 1 END) * 1.0E0 / greatest(count(l.quality), 1) AS sure, count(l.quality) * 1.0E0 / count(*) AS resolved FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY source"),
    "a7_service_metrics": statement(f"WITH r AS ({REQUEST}) SELECT service, count(*) AS total, count(CASE WHEN ok THEN 1 END) AS succeeded, count(CASE WHEN NOT ok THEN 1 END) AS failed, round(count(CASE WHEN ok THEN 1 END) * 100.0E0 / count(*), 2) AS success_rate, round(avg(latency), 4) AS avg_latency, round(min(latency), 4) AS min_latency, round(max(latency), 4) AS max_latency FROM r GROUP BY service"),
    "a8_global_metrics": statement(f"WITH r AS (SELECT * FROM ({REQUEST}) ORDER BY ts DESC, event_id DESC LIMIT 10000) SELECT count(*) AS total, count(CASE WHEN ok THEN 1 END) AS succeeded, count(DISTINCT service) AS services, round(avg(latency), 4) AS avg_latency FROM r"),
    "a9_health": statement(f"WITH r AS ({REQUEST}), s AS (SELECT CAST(user_id % 20 AS bigint) AS service, count(CASE WHEN ok THEN 1 END) * 100.0E0 / count(*) AS rate FROM r GROUP BY user_id % 20) SELECT service, CASE WHEN rate < 70 THEN 'unhealthy' WHEN rate < 90 THEN 'degraded' ELSE 'healthy' END AS health FROM s"),
    "a10_session_stats": statement(f"WITH s AS ({SESSION}) SELECT priority, count(*) AS n, count(CASE WHEN state = 'queued' THEN 1 END) AS queued, avg(CASE WHEN quality > 0 THEN quality END) AS avg_quality, count(CASE WHEN state = 'completed' THEN 1 END) * 1.0E0 / greatest(count(CASE WHEN state IN ('completed', 'failed') THEN 1 END), 1) AS success, sum(CAST(attempts AS bigint)) AS attempts FROM s GROUP BY priority", f"WITH s AS ({SESSION}) SELECT priority, count(*) AS n, count(CASE WHEN state = 'queued' THEN 1 END) AS queued, avg(CASE WHEN quality > 0 THEN quality END) AS avg_quality, count(CASE WHEN state = 'completed' THEN 1 END) * 1.0E0 / greatest(count(CASE WHEN state IN ('completed', 'failed') THEN 1 END), 1) AS success, CAST(sum(attempts) AS bigint) AS attempts FROM s GROUP BY priority"),
    "a12_stage_performance": statement(f"WITH r AS ({REQUEST}) SELECT service, avg(latency) AS mean_s, percentile(latency, 0.5) AS median_s, count(*) AS n, max(CASE WHEN latency > 0 THEN 1000.0E0 / latency END) AS peak FROM r GROUP BY service", f"WITH r AS ({REQUEST}) SELECT service, avg(latency) AS mean_s, quantile_cont(latency, 0.5) AS median_s, count(*) AS n, max(CASE WHEN latency > 0 THEN 1000.0 / latency END) AS peak FROM r GROUP BY service"),
    "a14_overall_progress": statement("SELECT user_id, avg(least(greatest(value, 0.0E0), 100.0E0)) AS progress FROM {events} GROUP BY user_id"),
    "a16_session_bounds": statement("SELECT c_custkey, min(o_orderdate) AS first_ts, CASE WHEN max(o_orderdate) < min(o_orderdate) THEN max(o_orderdate) + INTERVAL '1' DAY ELSE max(o_orderdate) END AS last_ts FROM {customer} JOIN {orders} ON c_custkey = o_custkey GROUP BY c_custkey"),
    "a17_pipeline_quality": statement("SELECT conv_id, avg(length(text)) AS avg_length, min(length(text)) AS min_length, max(length(text)) AS max_length, avg(CASE WHEN length(text) > 10 THEN 1.0E0 ELSE 0.0E0 END) AS validity FROM {conversations} GROUP BY conv_id"),
    "a18_throughput": statement("SELECT date_trunc('hour', ts) AS hour, count(*) / 60.0E0 AS per_minute, count(DISTINCT user_id) / 60.0E0 AS users_per_minute FROM {events} GROUP BY date_trunc('hour', ts)"),
    "a19_link_counts": statement("SELECT r_name, count(CASE WHEN kind = 'c' THEN 1 END) AS customers, count(CASE WHEN kind = 's' THEN 1 END) AS suppliers FROM {region} LEFT JOIN {nation} ON r_regionkey = n_regionkey LEFT JOIN (SELECT c_nationkey AS k, 'c' AS kind FROM {customer} UNION ALL SELECT s_nationkey, 's' FROM {supplier}) x ON n_nationkey = k GROUP BY r_name"),
    "a20_cache_stats": statement("SELECT count(*) AS entries, CAST(sum(p_size) AS bigint) AS total_size, avg(p_retailprice) AS mean_access, min(p_partkey) AS oldest, max(p_partkey) AS newest, count(CASE WHEN p_size > 25 THEN 1 END) * 1.0E0 / greatest(count(*), 1) AS hit_rate FROM {part}"),
    "a21_integration": statement("SELECT source, rate, CASE WHEN rate >= 0.9 THEN 'complete' WHEN rate >= 0.5 THEN 'partial' ELSE 'failed' END AS status FROM (SELECT source, least(1.0E0, greatest(0.0E0, 0.4 * count(l.doc_id) / count(*) + 0.6 * avg(CASE WHEN lang = 'en' THEN 1.0E0 ELSE 0.0E0 END))) AS rate FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY source)"),
    # counts within the row: sorted words, runs of equal ones
    # runs in the sorted array: where a word begins, and where the next one does
    "a22_word_share": statement("""SELECT doc_id, array_max(transform(s, (b, k) -> coalesce(get(s, k + 1), size(w)) - b)) * 1.0E0 / size(w) AS share
        FROM (SELECT doc_id, w, filter(sequence(0, size(w) - 1), k -> k = 0 OR get(w, k) <> get(w, k - 1)) AS s
        FROM (SELECT doc_id, array_sort(array_remove(split(lower(text), ' '), '')) AS w FROM {documents}) WHERE size(w) > 0)""", "SELECT doc_id, max(n) * 1.0 / sum(n) AS share FROM (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY doc_id, w) GROUP BY doc_id"),
    "a24_running_mean": statement("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS running FROM {events}"),
    "a25_dataset_report": statement("SELECT lang, count(*) AS n, percentile(n_chars, 0.5) AS median_chars, avg(n_chars) AS mean_chars FROM {documents} GROUP BY lang", "SELECT lang, count(*) AS n, quantile_cont(n_chars, 0.5) AS median_chars, avg(n_chars) AS mean_chars FROM documents GROUP BY lang"),
    "a26_service_rates": statement(f"WITH r AS ({REQUEST}) SELECT user_id, count(CASE WHEN ok THEN 1 END) * 1.0E0 / greatest(count(*), 1) AS hit_rate, count(CASE WHEN NOT ok THEN 1 END) * 1.0E0 / greatest(count(*), 1) AS failure_rate FROM r GROUP BY user_id"),
    # ---- windows and sequences
    "w11_gaps": statement("SELECT user_id, event_id, ts, prev FROM (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM {events}) WHERE ts > prev + INTERVAL '60' SECOND"),
    "w12_inconsistencies": statement("SELECT user_id, count(CASE WHEN value < p THEN 1 END) AS backwards, count(*) AS n, CASE WHEN count(CASE WHEN value < p THEN 1 END) * 1.0E0 / count(*) > 0.1 THEN 0.1E0 ELSE 0.0E0 END AS penalty FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM {events}) GROUP BY user_id"),
    "w15_progress_rates": statement("SELECT event_id, (value - p) / greatest(e - pe, 1) AS rate FROM (SELECT event_id, value, event_id AS e, lag(value) OVER w AS p, lag(event_id) OVER w AS pe, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE k <= 5"),
    "w16_linear_eta": statement("SELECT user_id, (100.0E0 - max_by(value, e)) / nullif((max_by(value, e) - min_by(value, e)) / nullif(max(e) - min(e), 0), 0) AS eta FROM (SELECT user_id, value, event_id AS e, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM {events}) WHERE k <= 10 GROUP BY user_id", "SELECT user_id, (100.0 - arg_max(value, e)) / nullif((arg_max(value, e) - arg_min(value, e)) / nullif(max(e) - min(e), 0), 0) AS eta FROM (SELECT user_id, value, event_id AS e, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k <= 10 GROUP BY user_id"),
    "w17_adaptive_eta": statement(
        """SELECT user_id, sum(rate * w) / sum(w) AS rate FROM (SELECT user_id, rate, power(2.0E0, row_number() OVER (PARTITION BY user_id ORDER BY back) - 1) AS w FROM
        (SELECT a.user_id, b.k - 1 AS back, (a.value - b.value) / (a.event_id - b.event_id) AS rate FROM k a JOIN k b ON a.user_id = b.user_id WHERE a.k = 1 AND b.k BETWEEN 2 AND 5) WHERE rate > 0) GROUP BY user_id""".replace("FROM k a JOIN k b", "FROM (SELECT user_id, value, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM {events}) a JOIN (SELECT user_id, value, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM {events}) b")
    ),
    "w18_stage_estimate": statement("SELECT user_id, sum(value * power(2.0E0, 10 - k)) / sum(power(2.0E0, 10 - k)) AS estimate FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM {events}) WHERE k <= 10 GROUP BY user_id"),
    "w20_milestones": statement("SELECT user_id, goal, min(ts) AS reached FROM (SELECT user_id, ts, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done FROM {events}) CROSS JOIN (SELECT * FROM VALUES (100), (500), (1000) AS t(goal)) WHERE done >= goal GROUP BY user_id, goal", "SELECT user_id, goal, min(ts) AS reached FROM (SELECT user_id, ts, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done FROM events), (VALUES (100), (500), (1000)) AS t(goal) WHERE done >= goal GROUP BY user_id, goal"),
    "w22_bounded_history": statement("SELECT event_id, user_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM {events}) WHERE k <= 3"),
    "w24_retry_schedule": statement(f"WITH s AS ({SESSION}) SELECT id, 5.0E0 * power(2.0E0, attempts - 1) AS minutes FROM s WHERE attempts > 0"),
    # ---- sorts, limits, top-k
    "k1_schedule": statement(f"WITH s AS ({SESSION}) SELECT id, priority FROM s WHERE state = 'queued' ORDER BY priority, created, id LIMIT 50"),
    "k4_newest_checkpoints": statement(f"WITH s AS ({SESSION}) SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY owner ORDER BY created DESC, id DESC) AS k FROM s) WHERE k <= 2"),
    "k5_newest_reports": statement("SELECT event_id, ts FROM {events} ORDER BY ts DESC, event_id DESC LIMIT 100"),
    "k8_stratified_sample": statement("SELECT doc_id, announcement FROM (SELECT d.doc_id, coalesce(l.toxic, 0) = 1 AS announcement, row_number() OVER (PARTITION BY coalesce(l.toxic, 0) = 1 ORDER BY md5(CAST(d.doc_id AS string)), d.doc_id) AS k FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id) WHERE k <= CASE WHEN announcement THEN 7 ELSE 18 END", "SELECT doc_id, announcement FROM (SELECT d.doc_id, coalesce(l.toxic, 0) = 1 AS announcement, row_number() OVER (PARTITION BY coalesce(l.toxic, 0) = 1 ORDER BY md5(CAST(d.doc_id AS varchar)), d.doc_id) AS k FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) WHERE k <= CASE WHEN announcement THEN 7 ELSE 18 END"),
    "k9_two_per_label": statement("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM {documents}) WHERE k <= 2"),
    # ---- set operations
    "u1_url_union": statement("SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}"),
    "u2_tag_overlap": statement("SELECT doc_id FROM {documents} WHERE arrays_overlap(array(lang, source), array('fr', 'src1', 'src2'))", "SELECT doc_id FROM documents WHERE list_has_any([lang, source], ['fr', 'src1', 'src2'])"),
    "u3_batch_concat": statement("SELECT doc_id, 1 AS batch FROM {documents} WHERE lang = 'fr' UNION ALL SELECT doc_id, 2 FROM {documents} WHERE n_chars > 1000"),
    "u4_pending": statement("SELECT doc_id FROM {documents} EXCEPT SELECT doc_id FROM {labels}"),
    # ---- triple-store queries
    "s5_plenary_documents": statement("SELECT DISTINCT p_partkey, p_name, o_orderdate FROM {part} JOIN {lineitem} ON p_partkey = l_partkey JOIN {orders} ON l_orderkey = o_orderkey WHERE contains(lower(p_type), 'e') AND p_brand = 'Brand#11' AND o_orderdate BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1997-12-31 00:00:00' ORDER BY o_orderdate, p_partkey LIMIT 1000"),
    "s7_author_search": statement("SELECT c_name, o_orderkey, o_orderdate FROM {customer} JOIN {orders} ON c_custkey = o_custkey WHERE contains(lower(c_name), '1') AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' ORDER BY o_orderdate DESC, o_orderkey LIMIT 500"),
    "s14_snapshots": statement("SELECT event_id, value FROM {events} ORDER BY ts DESC, event_id DESC LIMIT 100"),
    # ---- operations
    "n1_json_fallback": statement("SELECT event_id, coalesce(get_json_object(props, '$.title.en'), get_json_object(props, '$.k')) AS title FROM {events}", "SELECT event_id, coalesce(json_extract_string(props, '$.title.en'), json_extract_string(props, '$.k')) AS title FROM events"),
    "n2_array_dedup": statement("SELECT conv_id, array_join(array_sort(collect_set(role)), ',') AS roles FROM {conversations} GROUP BY conv_id", "SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM conversations GROUP BY conv_id"),
    "r1_requests_per_window": statement("SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(CAST(ts AS timestamp) AS bigint) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS recent FROM {events}", "SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS bigint) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS recent FROM events"),
    "r7_checkpoint_due": statement("SELECT event_id FROM (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM {events}) WHERE p IS NULL OR ts >= p + INTERVAL '30' MINUTE"),
    "r10_latest_state": statement("SELECT user_id, max_by(event_type, event_id) AS state FROM {events} GROUP BY user_id", "SELECT user_id, arg_max(event_type, event_id) AS state FROM events GROUP BY user_id"),
    # ---- scalar functions on names, addresses and errors
    "t40_alerts": statement("SELECT event_id, CASE WHEN value >= 95 THEN 'critical' WHEN value >= 80 THEN 'warning' END AS alert FROM {events}"),
    "t41_content_hash": statement("SELECT doc_id, substring(md5(text), 1, 12) AS short_md5, substring(sha2(text, 256), 1, 16) AS short_sha FROM {documents}", "SELECT doc_id, substr(md5(text), 1, 12) AS short_md5, substr(sha256(text), 1, 16) AS short_sha FROM documents"),
    "d4_duration_by_chars": statement("SELECT doc_id, greatest(10.0E0, least(1200.0E0, length(text) / 5.0E0 / 150.0E0 * 60.0E0)) AS seconds FROM {documents}"),
    "d12_retry_delay": statement(f"WITH s AS ({SESSION}) SELECT id, least(300.0E0, 2.0E0 * attempts) AS linear, least(300.0E0, 2.0E0 * power(2.0E0, attempts)) AS exponential FROM s"),
}
