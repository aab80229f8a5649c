"""webledger.sources."""
