"""Operators for large text corpora.

Nothing outside this folder imports it.  Each module holds one operator with a
general interface; ``queries`` derives the registered result tables from them.

Common rules, unless a docstring says otherwise: a null text is an empty text,
columns beyond those an operator names are ignored, column names of the input
may clash with any name an operator makes (it selects what it needs first), and
an empty table gives an empty result with the same columns.
"""
