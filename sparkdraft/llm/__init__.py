"""Operators of training-data pipelines on Spark; nothing else in the package imports this."""
