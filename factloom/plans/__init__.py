"""Query catalogue: importing it registers every query of the library."""

from factloom.plans import artifact_queries, cluster_queries, form_queries, grammar_queries, index_queries, part_queries, path_queries, record_queries, row_queries, search_queries, segment_queries  # noqa: F401  they register themselves
from factloom.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
