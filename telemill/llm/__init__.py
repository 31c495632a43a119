"""Operators for large text corpora: cleaning, deduplication, packing and scoring of training data.

Nothing else in the library imports this subpackage.
"""
