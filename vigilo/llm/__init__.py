"""Operators of a training-data pipeline (archives, scans, quality, dedup, packing, tokenising).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it can be imported.
"""
