"""The query of the n-gram Jaccard join. No SQL: tests hold it against a brute-force join."""

from __future__ import annotations

from quillrun.llm.jaccard_join import jaccard_classes
from quillrun.llm.registry import query, table


@query("op4_jaccard_classes")
def op4_jaccard_classes(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"))
