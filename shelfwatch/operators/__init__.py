"""Relational operators (DataFrame -> DataFrame), all lazy and driver-free."""
