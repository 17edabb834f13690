"""Operators over DataFrames: filters, joins, aggregates, windows, ordering, sets."""
