"""Operators of a training-data pipeline (packing, records, joins, WARC,
cleaning, extraction, classification, neighbour search, decontamination).

Nothing else in the library imports this subpackage.
"""
