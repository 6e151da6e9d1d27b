"""tidemark: sync warehouse tables and reconcile source with target, on Spark.

Functions take and return DataFrames. Only ``operators.sink``, ``plans.audit``,
``plans.sync``, ``plans.migrate`` and ``streaming.ingest`` write anything.
"""

__version__ = "0.1.0"
