"""Rows of a frame in an order that does not depend on it, for comparison in tests."""


def as_tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
