"""Operators for preparing language-model training data.

Nothing outside this folder imports it.  Each module holds one operator with a
general interface; :mod:`waymark.llm.queries` holds the thin queries over the
shared tables.
"""
