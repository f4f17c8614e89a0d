"""Operators for training-data pipelines (text, archive and vector tables).

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames, keeps the corpus partitioned by Spark and uses numpy / Arrow only
inside tasks, on batches of bounded size.
"""
