"""Reconcile large product catalogs and report on them, with Spark.

Every operator takes DataFrames and returns a DataFrame without running a job.
Only sinks, ``storage.stored`` and the plans that use them write; ``read_catalog``
lists the archives' entries first.
"""
