"""Column functions: scalars over text, addresses and times."""
