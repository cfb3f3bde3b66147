"""Tidemark: snapshot data preparation and model monitoring as Spark jobs.

Every operator is a plain function from DataFrames to a DataFrame.  Nothing
is collected to the driver except the handful of constants a model fit needs.
"""
