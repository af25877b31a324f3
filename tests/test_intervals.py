"""Activeness as intervals against counts by hand, against the carried table, and stored in runs."""

import random

import pytest

from viewstats.operators import content, intervals
from viewstats.plans import intervals as plan
from viewstats.schemas import CONTRACT_STATS, LOAD_DATE
from viewstats.sources.paths import stored_days, table_path
from viewstats.sources.sinks import clear_days, write_days

DAYS = [f"2022-04-{d:02d}" for d in range(1, 13) if d not in (5, 9)]


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


def stats(spark, active):
    """contract_stats of {contract: days}."""
    keys = spark.createDataFrame([(c, d) for c, days in active.items() for d in days],
                                 f"contract string, {LOAD_DATE} string")
    return spark.createDataFrame([], CONTRACT_STATS).unionByName(keys, allowMissingColumns=True)


def at_random(seed, contracts=12):
    rng = random.Random(seed)
    return {f"c{i}": sorted(rng.sample(DAYS, rng.randint(1, 8))) for i in range(contracts)}


def test_by_hand(spark):
    made = intervals.activeness_intervals(stats(spark, {"a": ["2022-04-01", "2022-04-04"], "b": ["2022-04-03"]}))
    assert rows(made.select("contract", "valid_from", "valid_to", "activeness")) == [
        ("1", "a", "2022-04-01", "2022-04-03"), ("1", "b", "2022-04-03", "None"), ("2", "a", "2022-04-04", "None")]


@pytest.mark.parametrize("seed", range(3))
def test_expanded_is_the_carried_table(spark, seed):
    table = stats(spark, at_random(seed))
    got = intervals.expanded(intervals.activeness_intervals(table), table)
    assert rows(got) == rows(content.activeness_carried(table))


def test_storage_grows_with_changes_only(spark):
    table = stats(spark, at_random(7))
    assert intervals.activeness_intervals(table).count() == table.count()


def test_as_of_any_day(spark):
    made = intervals.activeness_intervals(stats(spark, {"a": ["2022-04-02", "2022-04-04"]}))
    asked = spark.createDataFrame([("a", d, i) for i, d in enumerate(
        ["2022-04-01", "2022-04-02", "2022-04-03", "2022-04-04", "2030-01-01"])] + [("z", "2022-04-02", 9), (None, "2022-04-02", 10)],
        f"contract string, {LOAD_DATE} string, n int")
    got = {r["n"]: r["activeness"] for r in intervals.as_of(asked, made).collect()}
    assert got == {0: None, 1: 1, 2: 1, 3: 2, 4: 2, 9: None, 10: None}


def stored(spark, root):
    return rows(plan.read_intervals(spark, root))


@pytest.mark.parametrize("seed", range(2))
def test_runs_make_what_one_run_makes(spark, tmp_path, seed):
    root, active = str(tmp_path / "silver"), at_random(seed)
    path = table_path(root, "content", "contract_stats")
    for upto, start in (("2022-04-04", None), ("2022-04-08", "2022-04-05"), ("2022-04-12", "2022-04-09"),
                        ("2022-04-12", "2022-04-03")):  # the last one makes days in the middle again
        known = {c: [d for d in days if d <= upto] for c, days in active.items()}
        table = stats(spark, known)
        write_days(table, path)
        plan.run(spark, root, start)
        assert stored(spark, root) == rows(intervals.activeness_intervals(table))


def test_days_that_change_or_go(spark, tmp_path):
    root = str(tmp_path / "silver")
    path = table_path(root, "content", "contract_stats")
    write_days(stats(spark, {"a": DAYS[:4], "b": DAYS[1:3]}), path)
    plan.run(spark, root)
    clear_days(spark, path, [DAYS[2]])
    plan.run(spark, root, DAYS[2])
    left = stats(spark, {"a": [DAYS[0], DAYS[1], DAYS[3]], "b": [DAYS[1]]})
    assert stored(spark, root) == rows(intervals.activeness_intervals(left))
    clear_days(spark, path, stored_days(spark, path)[1:])
    plan.run(spark, root, DAYS[1])
    assert stored(spark, root) == rows(intervals.activeness_intervals(stats(spark, {"a": DAYS[:1]})))


def test_one_day_reads_what_holds_then(spark, tmp_path):
    root, table = str(tmp_path / "silver"), stats(spark, at_random(4))
    write_days(table, table_path(root, "content", "contract_stats"))
    plan.run(spark, root)
    held = plan.read_intervals(spark, root, "2022-04-06")
    assert "PartitionFilters: [isnotnull(closed_on" in held._jdf.queryExecution().toString()
    want = content.activeness_carried(table).where(f"{LOAD_DATE} = '2022-04-06'").drop(LOAD_DATE)
    assert rows(held.select("contract", "activeness")) == rows(want)


def test_nothing_stored(spark, tmp_path):
    assert plan.run(spark, str(tmp_path)) is None
    assert plan.read_intervals(spark, str(tmp_path)) is None
