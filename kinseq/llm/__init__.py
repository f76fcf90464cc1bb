"""Operators for building language-model training corpora.

Nothing outside this folder imports it.  Each ``<name>.py`` holds an operator with a general
interface; ``queries.py`` holds the thin contract queries and their SQL.
"""
