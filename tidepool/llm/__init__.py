"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this subpackage. Each operator module has
its own general interface (texts, spans, files, pairs); ``queries`` derives the
registered digest columns from it and ``sql`` holds the oracle SQL.
"""
