"""Operators for training data, one module a problem. Nothing outside this subpackage imports it."""
