"""wordmill.operators."""
