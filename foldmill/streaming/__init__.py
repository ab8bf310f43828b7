"""Results as they arrive."""
