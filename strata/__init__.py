"""Layered JSON-to-analytics processing as PySpark DataFrame operations.

Layers: raw snapshots -> landing -> sanitised -> curated, with batch audit and
reconciliation across them.  Operators take and return lazy DataFrames; only
``sinks``, ``plans`` and ``operators.numbering`` trigger jobs.
"""
