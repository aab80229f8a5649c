"""webledger.operators."""
