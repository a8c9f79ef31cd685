"""Batch text inference and structured output as Spark jobs."""

import sys

from pyspark import cloudpickle

from quillrun import schema
from quillrun.schema import JsonSchema

# Functions of this package travel to the executors inside the tasks that use them, so a cluster
# needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["JsonSchema", "schema"]
