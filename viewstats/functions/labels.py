"""Business labels as Column expressions."""

import re

from pyspark.sql import Column, functions as F

from viewstats.schemas import (
    APP_CATEGORIES, CATEGORY_LABELS, KEYWORD_CATEGORIES, OTHER_CATEGORY, UNMATCHED_KEYWORD)


def content_category(app_name: Column) -> Column:
    """Application code -> content category (case-sensitive, unknown or NULL is the rest class)."""
    label = F
    for category, codes in APP_CATEGORIES.items():
        label = label.when(app_name.isin(codes), category)
    return label.otherwise(OTHER_CATEGORY)


def keyword_category(keyword: Column) -> Column:
    """First category one of whose patterns occurs in the lower-cased keyword.

    One alternation per category keeps the generated method small enough for the JIT; the same
    rules as 162 ``contains`` calls exceed its limit and run interpreted.
    """
    lowered = F.lower(keyword)
    label = F
    for category, patterns in KEYWORD_CATEGORIES:
        label = label.when(lowered.rlike("|".join(map(re.escape, patterns))), category)
    return label.otherwise(UNMATCHED_KEYWORD)


def taste_profile() -> Column:
    """Labels of all categories with viewing time, joined by a dash in fixed order."""
    return F.concat_ws("-", *[F.when(F.col(c) > 0, label) for c, label in CATEGORY_LABELS.items()])


def usage_level(total: Column, q1: Column, q3: Column) -> Column:
    return F.when(total < q1, "Low").when(total > q3, "High").otherwise("Medium")


def clinginess_level(usage: Column, activeness: Column) -> Column:
    """Usage level moved up or down by the number of active days (limits 10 and 20)."""
    return (
        F.when(usage == "Low", F.when(activeness > 20, "Medium").otherwise("Low"))
        .when(usage == "Medium",
              F.when(activeness > 20, "High").when(activeness > 10, "Medium").otherwise("Low"))
        .when(usage == "High", F.when(activeness > 10, "High").otherwise("Medium"))
    )
