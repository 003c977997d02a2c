"""Column expressions: each takes and returns Spark columns, nothing runs on the driver."""
