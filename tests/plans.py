"""Helper: the physical plan of a DataFrame as text."""

import contextlib
import io


def plan_of(df, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()
