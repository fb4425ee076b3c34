"""Column expressions shared by batch jobs, streams and SQL functions."""
