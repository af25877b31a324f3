"""Data-quality rules: split, report, profile, gate, and de-duplication."""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from viewstats.schemas import LOAD_DATE, REJECTION_LIMITS

PASSED = "_passed"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


class QualityGateError(RuntimeError):
    """A day rejected more of its rows than its limit allows."""


def not_null(column: str) -> Rule:
    return Rule(f"not_null_{column}", F.col(column).isNotNull())


def non_negative(column: str) -> Rule:
    return Rule(f"non_negative_{column}", F.col(column) >= 0)


def content_rules() -> list[Rule]:
    required = [not_null(c) for c in ("contract", "mac", "total_duration")]
    return [*required, non_negative("total_duration")]


def search_rules() -> list[Rule]:
    return [not_null(c) for c in ("user_id", "keyword")]


def rules_for(data_type: str) -> list[Rule]:
    builders = {"content": content_rules, "search": search_rules}
    if data_type not in builders:
        raise ValueError(f"Unknown data_type: {data_type}")
    return builders[data_type]()


def passes(rules: list[Rule]) -> Column:
    """All rules hold; a rule that yields NULL counts as failed, so no row is lost."""
    return F.coalesce(reduce(and_, [r.predicate for r in rules], F.lit(True)), F.lit(False))


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.withColumn(PASSED, passes(rules))


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows; together they are the input."""
    return df.where(passes(rules)), df.where(~passes(rules))


def report(tagged: DataFrame, limit: float, by: str = LOAD_DATE) -> DataFrame:
    """Per day: rows, valid and invalid rows, rejection rate, and whether it is over the limit."""
    counted = tagged.groupBy(by).agg(
        F.count("*").alias("total"), F.count_if(~F.col(PASSED)).alias("invalid"))
    rate = F.col("invalid") / F.col("total")
    return counted.select(
        by, "total", (F.col("total") - F.col("invalid")).alias("valid"), "invalid",
        rate.alias("rate"), (rate > limit).alias("exceeded"))


def report_for(df: DataFrame, data_type: str) -> DataFrame:
    return report(tag(df, rules_for(data_type)), REJECTION_LIMITS[data_type])


def gate(daily_report: DataFrame) -> list:
    """Fail closed: raise when any day is over its limit, else return the report rows.

    The report holds one row per day, so bringing it to the driver is bounded by the calendar.
    """
    rows = daily_report.collect()
    refuse([r for r in rows if r["exceeded"]])
    return rows


def refuse(over_limit: list) -> None:
    if over_limit:
        detail = ", ".join(f"{r[LOAD_DATE]} {r['rate']:.2%}" for r in over_limit)
        raise QualityGateError(f"rejection rate over the limit: {detail}")


def rule_profile(df: DataFrame, rules: list[Rule], by: str = LOAD_DATE) -> DataFrame:
    """Per day and rule: how many rows pass, and which share; one pass over the input."""
    passed = df.groupBy(by).agg(
        F.count("*").alias("total"), *[F.count_if(r.predicate).alias(r.name) for r in rules])
    long = passed.unpivot([by, "total"], [r.name for r in rules], "rule", "passed")
    return long.withColumn("pass_pct", F.col("passed") / F.col("total") * 100)


def null_profile(df: DataFrame, columns: list[str], by: str = LOAD_DATE) -> DataFrame:
    """Per day and column: rows and NULLs; one pass over the input."""
    counted = df.groupBy(by).agg(
        F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([by, "total"], columns, "column_name", "null_count")


def dedup_by_id(df: DataFrame, key: str = "_id", collapse_missing: bool = False) -> DataFrame:
    """One row per day and ``_id``: of differing copies the greatest, so row order never matters.

    Rows without an ``_id`` (unparsable lines) are separate rows and stay separate: each gets a
    number of its own in the grouping key, which also spreads them over all tasks. With
    ``collapse_missing`` they count as copies of one another.
    """
    keys = [key, LOAD_DATE]
    rest = [c for c in df.columns if c not in keys]
    apart = F.lit(None).cast("long") if collapse_missing else F.monotonically_increasing_id()
    row_number = F.when(F.col(key).isNull(), apart)
    kept = (df.withColumn("_row", row_number).groupBy(*keys, "_row")
              .agg(F.max(F.struct(*rest)).alias("_kept")))
    return kept.select(*keys, "_kept.*").select(df.columns)
