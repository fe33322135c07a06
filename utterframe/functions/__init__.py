"""Column expressions of the speech data model."""
