"""Operators of a training-data pipeline.

Each module is one operator with a general interface (DataFrame in, DataFrame
out); ``registry`` binds them to the given tables as the ``opN_<name>``
queries.  Nothing outside this subpackage imports it.
"""
