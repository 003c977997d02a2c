"""Operators that prepare training text: filters, scans, duplicates, packing, archives."""
