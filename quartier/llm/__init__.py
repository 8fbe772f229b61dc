"""Operators of a training-data pipeline: scoring, filtering, de-duplication,
decontamination, token counting, web-archive derivatives and packing.

Nothing else in the library imports this package. ``queries`` registers one
query per operator; ``corpus_pipeline.py`` chains five of them.
"""
