"""Reusable DataFrame operators: shaping, aggregates, joins, ordering, audits."""
