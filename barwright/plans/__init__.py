"""Market views, registered queries and their oracles."""

from . import bar_queries, coverage_queries, function_queries, landing_queries, options_queries, stream_queries  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
