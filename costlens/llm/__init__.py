"""Operators of a training-data pipeline over text, page and vector tables.

Nothing outside this folder imports it. The functions that run in Python workers
are imported there, so executors need this package on their Python path.
"""
