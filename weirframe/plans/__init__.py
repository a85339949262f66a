"""Jobs, their summaries and the queries over the given tables."""
