"""Column-in, column-out functions. None of them is a Python UDF."""
