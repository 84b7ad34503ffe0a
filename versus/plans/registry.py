"""All registered queries and their oracle SQL."""

from __future__ import annotations

from versus.plans import (
    feature_queries,
    metric_queries,
    model_queries,
    source_queries,
    vector_queries,
)

_FAMILIES = [metric_queries, feature_queries, vector_queries, model_queries, source_queries]

QUERIES = {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}
ORACLE = {name: sql for family in _FAMILIES for name, sql in family.ORACLE.items()}

# The stream's final state equals the batch result.
ORACLE["stream_confusion"] = ORACLE["confusion_matrix"]
