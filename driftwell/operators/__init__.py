"""Relational operators: aggregation, grouping, windows, joins, sets, cubes."""
