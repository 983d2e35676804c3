"""Folders of test tables and comparison helpers shared by the test modules."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Sorted list of tuples (selected columns) for exact comparisons."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, x) for x in t))
