"""Reports and the registered queries."""

import importlib

from tablework.plans.registry import QUERIES, Query

QUERY_MODULES = (
    "source_queries", "filter_queries", "join_queries", "agg_queries", "window_queries", "reshape_queries",
    "expression_queries", "history_queries", "report_queries",
)


def load_queries() -> dict[str, Query]:
    for module in QUERY_MODULES:
        importlib.import_module(f"tablework.plans.{module}")
    return dict(QUERIES)
