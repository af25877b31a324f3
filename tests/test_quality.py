import pytest
from pyspark.sql import functions as F

from viewstats.operators import quality
from viewstats.schemas import BRONZE_CONTENT

DAY = "2022-04-01"


def content_rows(spark, good, bad, day=DAY):
    rows = [(f"g{i}", "c", "m", i, "VOD", day) for i in range(good)]
    rows += [(f"b{i}", None if i % 2 else "c", "m", 5 if i % 2 else -1, "VOD", day) for i in range(bad)]
    return spark.createDataFrame(rows, BRONZE_CONTENT)


def search_rows(spark, good, bad):
    rows = [("u", "k", DAY)] * good + [("u" if i % 2 else None, None, DAY) for i in range(bad)]
    return spark.createDataFrame(rows, "user_id string, keyword string, _load_date string")


@pytest.mark.parametrize("bad, exceeded", [(0, False), (5, False), (6, True)])
def test_content_gate(spark, bad, exceeded):
    report = quality.report_for(content_rows(spark, 100 - bad, bad), "content")
    row = report.first()
    assert (row["total"], row["valid"], row["invalid"], row["exceeded"]) == (100, 100 - bad, bad, exceeded)
    assert row["rate"] == bad / 100
    if exceeded:
        with pytest.raises(quality.QualityGateError, match=DAY):
            quality.gate(report)
    else:
        quality.gate(report)


@pytest.mark.parametrize("bad, exceeded", [(40, False), (41, True)])
def test_search_gate(spark, bad, exceeded):
    assert quality.report_for(search_rows(spark, 100 - bad, bad), "search").first()["exceeded"] is exceeded


def test_gate_of_nothing_passes(spark):
    assert quality.gate(quality.report_for(content_rows(spark, 0, 0), "content")) == []


def test_gate_looks_at_each_day(spark):
    mixed = content_rows(spark, 1000, 0).unionByName(content_rows(spark, 9, 1, "2022-04-02"))
    with pytest.raises(quality.QualityGateError, match="2022-04-02"):
        quality.gate(quality.report_for(mixed, "content"))


def test_unknown_data_type():
    with pytest.raises(ValueError):
        quality.rules_for("video")


def test_split_loses_no_row_when_a_rule_is_null(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x long")
    valid, invalid = quality.split(df, [quality.non_negative("x")])
    assert [r["x"] for r in valid.collect()] == [1]
    assert sorted(str(r["x"]) for r in invalid.collect()) == ["-1", "None"]


def test_profiles(spark):
    df = content_rows(spark, 8, 2)
    rules = {r["rule"]: (r["passed"], r["pass_pct"])
             for r in quality.rule_profile(df, quality.content_rules()).collect()}
    assert rules == {"not_null_contract": (9, 90.0), "not_null_mac": (10, 100.0),
                     "not_null_total_duration": (10, 100.0), "non_negative_total_duration": (9, 90.0)}
    nulls = {r["column_name"]: r["null_count"]
             for r in quality.null_profile(df, ["contract", "mac"]).collect()}
    assert nulls == {"contract": 1, "mac": 0}


def dedup_input(spark):
    rows = [("1", "c", "m", 5, "VOD", DAY)] * 500          # a third of all rows: exact copies
    rows += [("2", None, "m", 9, "VOD", DAY), ("2", "c", "m", 1, "VOD", DAY), ("2", "c", "m", 3, "VOD", DAY)]
    rows += [("1", "c", "m", 5, "VOD", "2022-04-02")]      # same id on another day
    rows += [(None, None, None, None, None, DAY)] * 400     # unparsable lines
    rows += [(f"x{i}", "c", "m", i, None, DAY) for i in range(500)]
    return spark.createDataFrame(rows, BRONZE_CONTENT)


def test_dedup(spark):
    rows = quality.dedup_by_id(dedup_input(spark)).collect()
    assert len(rows) == 1 + 1 + 1 + 400 + 500
    assert [(r["contract"], r["total_duration"]) for r in rows if r["_id"] == "2"] == [("c", 3)]
    assert sum(r["_id"] is None for r in rows) == 400


def test_dedup_does_not_depend_on_order(spark):
    df = dedup_input(spark)
    again = df.orderBy(F.rand(3)).repartition(7)
    key = lambda rows: sorted(map(str, rows))
    assert key(quality.dedup_by_id(again).collect()) == key(quality.dedup_by_id(df).collect())


def test_dedup_may_collapse_missing_ids(spark):
    rows = quality.dedup_by_id(dedup_input(spark), collapse_missing=True).collect()
    assert sum(r["_id"] is None for r in rows) == 1
