"""wordmill.plans."""
