"""Writers: stored tables, users, registry, exports."""
