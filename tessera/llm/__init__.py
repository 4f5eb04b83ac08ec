"""Operators for preparing training corpora (one module per operator, see ``queries.py``)."""
