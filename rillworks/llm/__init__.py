"""Operators for preparing training text: selection, de-duplication, counting, packing.

Nothing else in the package imports this one.
"""
