"""Operators for building language-model training data.

Nothing else in the package imports this folder; it may use the general helpers of the package.
"""
