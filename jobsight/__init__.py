"""jobsight: vacancy-market analytics as Spark DataFrame jobs.

Layers:

* ``sources``   – landed JSON pages, the driver-table fixture, source predicates.
* ``functions`` – column expressions: classification rules, exact money arithmetic.
* ``operators`` – DataFrame -> DataFrame building blocks: normalise, candidates,
  upsert, checks, aggregates, numbering, size-checked lookup joins.
* ``sinks``     – versioned dataset writes and the run log.
* ``plans``     – the seven marts and the daily load, composed from operators.
* ``streaming`` – the same daily load driven by Structured Streaming.
"""

from jobsight.session import build_session, storage_root

__all__ = ["build_session", "storage_root"]
