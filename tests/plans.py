import contextlib
import io


def plan_of(df) -> str:
    """All plans of a frame as text."""
    held = io.StringIO()
    with contextlib.redirect_stdout(held):
        df.explain(True)
    return held.getvalue()
