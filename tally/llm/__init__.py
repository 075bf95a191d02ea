"""Operators for preparing text for training language models.

Nothing outside this folder imports it; ``__spark_entry__.py`` registers its queries when present.
"""
