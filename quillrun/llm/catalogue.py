"""All queries of this folder."""

from quillrun.llm import (join_query, lexical_query, manifest_query, mixing_query, model_queries, native_queries,
                          repeat_queries, search_query, token_query)
from quillrun.llm.registry import QUERIES, SQL

MODULES = (join_query, lexical_query, manifest_query, mixing_query, model_queries, native_queries, repeat_queries,
           search_query, token_query)

__all__ = ["MODULES", "QUERIES", "SQL"]
