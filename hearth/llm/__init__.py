"""Operators for building training-data sets (sharding, language ID, deduplication,
toxicity, chat formatting, decontamination, mixing, nearest neighbours).

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only where it is present.
"""
