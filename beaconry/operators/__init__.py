"""Relational operators that take and return DataFrames."""
