"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its
queries only where it can be imported).  Every operator takes DataFrames and
column names, reads only the columns it names (extra columns, also with
clashing names, never reach it) and treats a null text as an empty one.
"""
