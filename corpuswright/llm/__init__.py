"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Each module holds one operator with its
general interface; queries.py applies them to the provided tables.
"""
