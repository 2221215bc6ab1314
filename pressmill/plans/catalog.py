"""All queries by name, with hand-written SQL for those that SQL can express."""

from . import element_queries, html_queries, io_queries, rule_queries, run_queries, status_queries, text_queries, url_queries

_MODULES = (url_queries, text_queries, html_queries, element_queries, status_queries, io_queries, run_queries, rule_queries)
QUERIES: dict = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict = {k: v for m in _MODULES for k, v in m.SQL.items()}
