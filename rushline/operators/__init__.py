"""DataFrame operators: every one takes tables and returns lazy tables."""
