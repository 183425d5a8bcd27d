"""Column functions: text, casts, partition keys and times. All are built-in expressions."""
