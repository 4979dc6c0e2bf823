"""Operators for large-scale training-data pipelines.

Each module holds one operator with its general interface; ``registry`` holds
the thin ``opN_<name>`` queries.  Nothing outside this package imports it
except the guarded hook in ``__spark_entry__.py``.
"""
