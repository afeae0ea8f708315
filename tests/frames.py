"""What several tests do with frames."""

import contextlib
import io


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_text(df):
    """The physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
