"""Operators for preparing language-model training data.

Everything here is used by its own queries (``queries.py``) only; nothing else
in the library imports this subpackage.
"""
