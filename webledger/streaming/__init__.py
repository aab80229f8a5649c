"""webledger.streaming."""
