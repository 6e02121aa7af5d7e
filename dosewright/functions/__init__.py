"""Column-level building blocks. No function here triggers a job."""
