"""Column functions: pure expressions over columns, evaluated inside generated code."""
