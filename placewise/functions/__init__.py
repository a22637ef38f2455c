"""Column functions over posts; all are built-in expressions."""
