"""Operators for training data at scale: mixing, dedup, decontamination, quality, formatting, output.

Nothing else in the library imports this subpackage.
"""
