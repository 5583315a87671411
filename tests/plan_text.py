"""Text of a DataFrame's plans, as ``explain`` prints them."""

import contextlib
import io


def plan_text(df, mode: str = "extended") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
