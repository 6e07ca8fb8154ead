"""Operators for preparing text and vectors as training data.

Nothing else in the package imports this subpackage."""
