"""All registered queries."""

from quillrun.plans import (batches, files, flagship, model_calls, parsing, request_tables,
                            stream_queries, structured_output, text_reports, vector_queries)
from quillrun.plans.registry import QUERIES, SQL

MODULES = (files, request_tables, batches, model_calls, parsing, structured_output, text_reports,
           vector_queries, stream_queries, flagship)

__all__ = ["MODULES", "QUERIES", "SQL"]
