"""Operators for text corpora that train language models.

Nothing outside this package imports it. Every operator takes DataFrames and names the columns
it works on; other columns never matter to it. `queries.py` applies each operator to the
benchmark tables.
"""
