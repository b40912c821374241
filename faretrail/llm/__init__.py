"""Operators for preparing training text: tokens, quality, safety, duplicates, packing.

Nothing else in the library imports this subpackage; it can be removed as a whole.
"""
