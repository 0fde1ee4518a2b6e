"""End-to-end plans, and the queries registered over the given tables."""
