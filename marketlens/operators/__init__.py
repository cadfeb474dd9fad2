"""DataFrame operators: flattening, projection, filters, joins, aggregation, windows, sorts, unions, checks."""
