"""Operators that need more than one built-in call to stay distributed."""
