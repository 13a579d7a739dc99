"""Vessel-activity events on Spark.

Scored position messages and upstream vessel tables in; fishing, encounter,
loitering and port-visit events out.  Every operator is a function from
DataFrames to a DataFrame; only ``sources.tables`` and
``streaming.incremental`` write.
"""
