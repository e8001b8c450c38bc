"""Scalar functions as Column expressions; array kernels in pandas only where Spark has no special function."""
