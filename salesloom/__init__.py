"""salesloom: retail sales analytics written as Spark DataFrame jobs.

Layers, bottom up:

* ``functions``  column expressions (bands, ratios, dates, line measures)
* ``sources``    scans, the adapter over the driver tables, and sinks
* ``operators``  DataFrame -> DataFrame operators (cleaning, star schema, catalogue, BI measures, ...)
* ``plans``      physical-layout helpers (ordered prefix sums, published star tables) and the query registry
* ``streaming``  incremental refresh of the daily aggregate
"""
