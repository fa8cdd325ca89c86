"""What several test modules share. Not in conftest: two folders have one, and imports by that name find either."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collect ``cols`` (default all) as a list of tuples in a stable order."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as printed by ``explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
