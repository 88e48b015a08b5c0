"""quartermet: hourly weather observations to quarterly station features, on Spark.

Sub-packages
    sources     readers of delimited text, archives, listings, staged parquet
    functions   column helpers (quarter bounds, paths, version names, ratios)
    operators   cleaning, features, enrichment, quality, serving, catalogue
    sinks       staged and curated parquet writers
    streaming   request-log analytics and incremental loads
    plans       whole jobs, and the queries registered for the checks
"""
