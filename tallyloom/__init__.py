"""Spark jobs over shop events: feature tables, windows, latency, quality checks.

Every operator is a plain function from DataFrame to DataFrame. It builds a
lazy plan and never counts, caches or collects; only the writers in
``sources.writers``, the stream starters in ``streaming`` and the runs in
``plans`` and ``jobs`` start work.
"""
