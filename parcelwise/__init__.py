"""Property-listing lakehouse analytics and training-data operators on PySpark."""
