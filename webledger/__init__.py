"""webledger: table and stream operators for captured web data and metered calls."""

__version__ = "0.1.0"
