"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries``
registers one thin query per operator over its whole table. Nothing outside
this package (and ``corpus_pipeline.py``) imports it.
"""
