"""Operators for preparing language-model training data, on Spark.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames and column names, keeps the work in Spark tasks, and documents
what nulls, empty texts, ties and repeated rows give.
"""
