"""End-to-end plans: bridge tables, the query catalogue and the command line."""
