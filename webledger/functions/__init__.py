"""webledger.functions."""
