"""Trending-observation analytics on Spark DataFrames.

Every operator takes and returns a ``DataFrame`` (or a ``Column``), takes column
names as parameters and runs no action of its own unless its docstring says so.
"""
