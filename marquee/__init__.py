"""Event analytics and batch recommendation on PySpark DataFrames."""
