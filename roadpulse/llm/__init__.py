"""Operators of a training-data pipeline, each by one named method.

Nothing else in the package imports this folder.
"""
