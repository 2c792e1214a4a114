"""Comparing collected rows."""


def rows(df, *cols):
    """Collected rows as tuples (optionally of selected columns), sorted."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))
