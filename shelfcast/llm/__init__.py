"""Operators for preparing language-model training data, on Spark.

Nothing outside this subpackage imports it. Each module holds one operator with its own
interface; `catalog.py` registers the thin queries over the driver tables.
"""
