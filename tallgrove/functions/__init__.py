"""Column functions, parameter tables and SQL routines."""
