"""Helpers of the engine's tests."""


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())
