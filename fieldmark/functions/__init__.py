"""Column functions: numbers, calendar and hashing."""
