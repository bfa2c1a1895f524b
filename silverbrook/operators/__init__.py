"""Relational operators that more than one pipeline uses."""
