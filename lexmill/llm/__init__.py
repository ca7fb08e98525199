"""Operators of a training-data pipeline: media, deduplication, filtering, tokenizing, archives.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator.
"""
