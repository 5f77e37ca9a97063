"""Risk indicators from gridded, vector and tabular data, as lazy Spark plans.

``functions``  column expressions: rounding, ratios, classes, projections
``operators``  joins, zonal statistics, raster algebra, runs, ranks, least-cost paths
``plans``      composite indicators, the combined table, risk scores, the run scheduler
``sources``    readers for landed files; writers and manifests
``streaming``  the same logic on streams
``queries``    everything over the driver's tables, each with an SQL twin
"""
