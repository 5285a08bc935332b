"""All registered queries of the library but those of its subpackage for training text."""

from __future__ import annotations

from wordgrove.plans import candidate_queries, check_queries, edit_queries, forest_queries, lookup_queries, pipeline_queries, source_queries, sql_queries, stats_queries, text_queries  # noqa: F401  (each registers its queries)
from wordgrove.plans.registry import QUERIES, SQL

FLAGSHIP = "t05_subtree_agg"


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
