"""Service-performance analytics on PySpark: DataFrames in, DataFrames out."""
