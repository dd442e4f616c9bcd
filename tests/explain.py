"""Plans as text."""

import contextlib
import io
import re


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def exchanges(plan):
    """What each shuffle of a formatted plan takes in."""
    return re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*?)\]\n", plan)
