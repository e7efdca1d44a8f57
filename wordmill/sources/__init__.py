"""wordmill.sources."""
