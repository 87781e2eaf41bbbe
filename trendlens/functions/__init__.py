"""Column functions: built-in expressions only, so they stay in generated code."""
