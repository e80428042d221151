"""Moving changing data into tables with Spark.

Incremental table reads, CSV feeds and message envelopes, stream joins within a
time interval, upserts into keyed tables and databases, and table maintenance.
Every operator takes and returns DataFrames; the data work runs on the cluster.
"""
