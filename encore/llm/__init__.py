"""Operators of a training-data pipeline: deduplication, search, scoring,
packing, decontamination, tokens and chat formatting.

Nothing else in the library imports this package. ``llm.queries`` registers
one ``opN_<name>`` query per operator.
"""
