"""DataFrame operators: rows, joins, aggregates, ordered series, metrics."""
