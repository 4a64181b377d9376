"""Composed plans: fixtures derived from the driver tables and the registered queries."""
