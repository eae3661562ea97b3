"""Composable analytics operators for PySpark: DataFrames in, DataFrames out."""
