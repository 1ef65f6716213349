"""Operators for preparing text and vector corpora (queries in ``queries.py``)."""
