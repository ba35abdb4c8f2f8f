"""Product-analytics operators for PySpark.

Every operator takes DataFrames (and, where time matters, an explicit
``as_of``) and returns a lazy DataFrame built from Spark built-ins only.
"""
