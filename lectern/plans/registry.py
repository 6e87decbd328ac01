"""Names, queries and SQL of the library's own operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.plans import landed_queries, lifecycle_queries, loop_queries, mention_queries, misc_queries, record_queries, relational_queries, rule_queries, run_queries, stage_queries, store_queries, transcript_queries

Query = Callable[[SparkSession, str], DataFrame]
_PAIRS = transcript_queries.PAIRS | relational_queries.PAIRS | misc_queries.PAIRS | record_queries.PAIRS | lifecycle_queries.PAIRS | mention_queries.PAIRS | store_queries.PAIRS | stage_queries.PAIRS | run_queries.PAIRS | landed_queries.PAIRS | loop_queries.PAIRS | rule_queries.PAIRS


def queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in _PAIRS.items()}


def oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _PAIRS.items() if sql}
