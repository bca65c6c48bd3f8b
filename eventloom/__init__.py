"""Event-sequence analytics on PySpark DataFrames."""
