import contextlib
import io
from datetime import date
from decimal import Decimal

D = Decimal


def day(text):
    return date.fromisoformat(text)


def tuples(df, *cols):
    """Rows as plain tuples, sorted with NULLs first."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(type(v)), v if v is not None else 0) for v in r])


def same(left, right):
    """Equal rows including duplicates, column order aside."""
    cols = sorted(left.columns)
    assert cols == sorted(right.columns)
    a, b = left.select(*cols), right.select(*cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan_of(df, mode="formatted"):
    """The physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
