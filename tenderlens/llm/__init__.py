"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; its registered query is in :mod:`tenderlens.llm.queries`.
"""
