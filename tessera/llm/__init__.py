"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``benchmark``.

One module per operator. Each holds the operator with its own general interface, a
thin ``query(spark, sf_dir)`` that applies it to the whole table and derives the
digest columns, and, where SQL can express the result, ``ORACLE`` for DuckDB.
"""
