"""Training-data operators: packing, filters, scans, dedup, scoring, mixing.

Nothing else in the library imports this subpackage.
"""
