"""Column-level scalar functions (time, hashing, fixed texts)."""
