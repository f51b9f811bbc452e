"""Readers: stored tables, landed pages, mined logs, CI archives."""
