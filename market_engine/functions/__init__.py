"""Column expressions: no I/O, no actions, only Spark built-ins."""
