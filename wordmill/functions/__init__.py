"""wordmill.functions."""
