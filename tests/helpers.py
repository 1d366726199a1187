"""Shared by the tests."""


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
