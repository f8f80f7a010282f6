"""The catalogue of queries."""
