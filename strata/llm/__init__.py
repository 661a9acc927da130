"""Operators for preparing training text, and the queries that apply them.

Nothing else in the library imports this package. ``queries`` holds the
registered queries, one module per operator holds the rest; ``textops`` and
``tables`` hold what several operators share.
"""
