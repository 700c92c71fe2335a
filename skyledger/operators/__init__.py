"""DataFrame operators: shaping, joins, table maintenance, quality and governance."""
