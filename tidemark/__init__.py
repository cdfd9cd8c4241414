"""tidemark: point-in-time market and macro time-series operators on Spark.

Every operator is a function from DataFrames to a DataFrame, composed of
built-in Spark expressions, joins and windows.
"""
