"""Column expressions; nothing in this package runs a job."""
