"""Product-analytics and dimensional-modelling operators for PySpark.

Every operator is a plain function from DataFrames to a DataFrame. Nothing here
registers views, sets session options or collects data on the driver unless its
docstring says so.
"""
