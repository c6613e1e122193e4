"""Operators for training-data pipelines over text corpora.

Nothing else in the package imports this subpackage.
"""
