"""Execution modes as day ranges."""

from datetime import date, timedelta

from viewstats.functions import run_date


def day_range(mode: str = "incremental", start=None, end=None, today=None):
    """``incremental`` is yesterday, ``date_range`` is given, ``full`` is every stored day."""
    if mode == "incremental":
        current = date.fromisoformat(run_date(today)) if today else date.today()
        yesterday = (current - timedelta(days=1)).isoformat()
        return yesterday, yesterday
    if mode == "date_range":
        if start is None or end is None:
            raise ValueError("date_range needs start and end")
        return run_date(start), run_date(end)
    if mode == "full":
        return None, None
    raise ValueError(f"Unknown mode: {mode}")
