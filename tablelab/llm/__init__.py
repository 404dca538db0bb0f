"""Operators for corpora of training text. Nothing outside this subpackage imports it."""
