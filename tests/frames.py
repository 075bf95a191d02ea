"""Helpers for comparing DataFrames in tests."""


def rows(df):
    """Rows as sorted tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
