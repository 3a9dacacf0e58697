"""Shared by the tests that compare with SQL."""

TABLES = "region nation customer supplier part orders lineitem".split()


def ordered(columns, rows):
    """Rows with columns in name order, sorted; nulls last."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: tuple((v is None, str(type(v)), 0 if v is None else v) for v in r)
    return sorted((tuple(r[i] for i in at) for r in rows), key=key)
