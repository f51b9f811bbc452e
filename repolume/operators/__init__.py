"""Operators: lazy ``DataFrame -> DataFrame`` functions with column names as arguments."""
