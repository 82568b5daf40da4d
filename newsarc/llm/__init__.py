"""Operators of a training-data pipeline (sharding, dedup, scoring, packing ...).

Nothing else in the library imports this subpackage. Each module holds one
operator; ``queries.py`` registers one query per operator.
"""
