"""Operators of a training-data pipeline: scoring, deduplication, extraction, packing.

Nothing outside this package imports it. Each module holds one operator with a
general interface; ``queries`` binds them to the tables with production
parameters.
"""
