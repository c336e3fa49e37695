"""Training-data operators: thirteen large-corpus components on Spark.

Each module holds one operator with its own general interface and the
``opN_<name>`` query that applies it to a whole table.  ``catalog`` lists
the queries and their SQL; nothing outside this package imports it except
the guarded registration in ``__spark_entry__.py``.
"""
