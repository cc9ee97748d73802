"""Keyed-event tables on PySpark.

Rows live in tables with a declared primary key; a write with an existing key
replaces the row.  Events arrive as framed text records, in batches or as a
stream, and are parsed, checked and upserted with DataFrames only.
"""
