"""Column factories."""
