"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries (``catalog.py``) when it can be imported. Each operator is a
module of its own; ``common.py`` holds what they share.
"""
