"""Operators for preparing training text: fingerprints, joins, mixing, scoring, archives and search."""
