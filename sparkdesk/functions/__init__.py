"""Column functions. Every one of them is a plain Catalyst expression."""
