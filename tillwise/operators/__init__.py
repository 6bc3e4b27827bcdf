"""DataFrame operators: cleaning, validation, joins, windows, aggregates, layout."""
