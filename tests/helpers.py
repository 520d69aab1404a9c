"""Helpers of the tests."""

import io
from contextlib import redirect_stdout


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
