"""Operators for preparing training data, as Spark jobs.

Each module holds one operator; ``queries`` has the registered queries.
Nothing outside this subpackage imports it.
"""
