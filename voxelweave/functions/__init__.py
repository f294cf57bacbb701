"""Column expressions, sizing helpers and block kernels."""
