import datetime as dt

D = dt.date
T = dt.datetime


def rows(df, *cols, order=None):
    """Collect selected columns as tuples, sorted for order-free asserts."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
