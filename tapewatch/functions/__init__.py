"""Column expressions shared by the batch and streaming jobs. All are built-in Spark functions."""
