"""Training-data operators: thirteen Spark jobs over a documents (or pages) table.

Every operator takes DataFrames and column names and returns DataFrames; the
fixed queries of ``__spark_entry__.py`` live in ``queries.py``.
"""
