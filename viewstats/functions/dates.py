"""Run dates, month bounds and load-date filters."""

from datetime import date, timedelta

from pyspark.sql import Column, functions as F


def run_date(value) -> str:
    """``2022-04-01T02:00:00`` or ``2022-04-01`` or a date -> ``2022-04-01``."""
    return date.fromisoformat(str(value).split("T")[0].split(" ")[0]).isoformat()


def month_bounds(month: str) -> tuple[str, str]:
    """``2022-06`` -> first day of the month and first day of the next one."""
    first = date.fromisoformat(f"{month}-01")
    following = (first + timedelta(days=31)).replace(day=1)
    return first.isoformat(), following.isoformat()


def load_date_range(column: Column, start=None, end=None) -> Column:
    """Inclusive day range on a string or date column; an open end keeps everything."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (column >= F.lit(run_date(start)).cast("date"))
    if end is not None:
        condition = condition & (column <= F.lit(run_date(end)).cast("date"))
    return condition
