"""Whole pipelines: which tables to build, and how they follow from landed and mined data."""
