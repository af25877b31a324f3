"""Column-to-Column functions; all of them are built-in expressions."""

from viewstats.functions.dates import load_date_range, month_bounds, run_date
from viewstats.functions.labels import (
    clinginess_level, content_category, keyword_category, taste_profile, usage_level)

__all__ = [
    "clinginess_level", "content_category", "keyword_category", "load_date_range",
    "month_bounds", "run_date", "taste_profile", "usage_level",
]
