"""All registered queries."""

from lapwise.queries import form_queries, learn_queries, report_queries, silver_queries, source_queries  # noqa: F401
from lapwise.queries.registry import QUERIES, SQL  # noqa: F401
