"""Operators for training-data text: duplicates, term statistics, script folding, sampling, encoding, leaks, splitting.

Nothing outside this subpackage imports it.
"""
