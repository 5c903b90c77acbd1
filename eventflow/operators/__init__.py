"""DataFrame-in / DataFrame-out operators (windows, ranking, distinct, joins, patterns, caps)."""
