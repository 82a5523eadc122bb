"""Column expressions. All of them are built from native functions, no UDFs."""
