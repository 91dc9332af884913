"""florafold — Spark-native toolkit for observation records held as many datasets.

Modules:
    session      SparkSession builder, checkpoint folder, table loader.
    sources      scans, file inventory, dataset catalogue, sinks, archives, versions.
    functions    scalar column functions and the JSON predicate compiler.
    operators    flattening, facets and checks, planning windows, retention, enrichment.
    plans        composite jobs (flatten_index, validate_and_publish, plan_ingest, ...).
    streaming    (empty by design; the reference has no streaming work).
"""

__all__ = ["session"]
