"""Developer-activity analytics on PySpark DataFrames."""
