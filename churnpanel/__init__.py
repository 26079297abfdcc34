"""Account-level churn and customer-value analytics on PySpark.

Every operator is a function from DataFrames to a lazy DataFrame, built from
Spark's own expressions.  See the README for the map of the package.
"""
