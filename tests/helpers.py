def rows(df, *order):
    """Rows as tuples, sorted by the text of their values."""
    found = [tuple(r) for r in df.collect()]
    return found if order else sorted(found, key=repr)
