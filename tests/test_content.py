"""Hand-written day and its golden rows, and properties over many days."""

import random

import pytest
from pyspark.sql import Row, functions as F

from viewstats.operators import content
from viewstats.operators.quantiles import discrete_quantiles
from viewstats.schemas import BRONZE_CONTENT, CONTRACT_STATS, STATS_CATEGORIES

DAY = "2022-04-01"


def bronze(spark, rows, day=DAY):
    return spark.createDataFrame(
        [(str(i), c, m, d, a, day) for i, (c, m, a, d) in enumerate(rows)], BRONZE_CONTENT)


def stats_of(spark, contract_days):
    """contract_stats rows with nothing but keys: [(contract, day), ...]."""
    zero = [0] * len(STATS_CATEGORIES)
    return spark.createDataFrame([(c, *zero, 1, d) for c, d in contract_days], CONTRACT_STATS)


def as_dict(df, *columns):
    return {tuple(r[c] for c in columns[:-1]): r[columns[-1]] for r in df.collect()}


@pytest.fixture(scope="module")
def micro(spark):
    return bronze(spark, [
        ("c1", "m1", "CHANNEL", 100), ("c1", "m2", "VOD", 50),
        ("c2", "m1", "RELAX", 30), ("c2", "m3", "CHILD", 30),
        ("c3", "m4", "UNKNOWN", 40), ("c3", "m4", None, 30),
        ("c4", "m5", "SPORT", 10), ("c5", "m6", "VOD", 1000)])


@pytest.fixture(scope="module")
def stats(micro):
    return content.contract_stats(content.enrich(micro)).persist()


def test_contract_stats(stats):
    rows = {r["contract"]: r.asDict() for r in stats.collect()}
    assert {c: r["total_devices"] for c, r in rows.items()} == {
        "c1": 2, "c2": 2, "c3": 1, "c4": 1, "c5": 1}
    assert rows["c1"]["Truyền Hình"] == 100 and rows["c1"]["Phim Truyện"] == 50
    assert rows["c3"]["Khác"] == 70
    assert stats.schema.simpleString() == CONTRACT_STATS.simpleString()


def test_columns_do_not_depend_on_the_day(spark):
    only_sport = content.contract_stats(content.enrich(bronze(spark, [("c", "m", "SPORT", 5)])))
    assert only_sport.columns == CONTRACT_STATS.fieldNames()
    summary = content.daily_summary(only_sport, content.platform_devices(
        bronze(spark, [("c", "m", "SPORT", 5)]))).first()
    assert summary["Thể Thao"] == 5 and summary["Giải Trí"] == 0 and summary["total_duration"] == 5


def test_daily_summary(micro, stats):
    row = content.daily_summary(stats, content.platform_devices(micro)).first()
    assert [row[c] for c in ("Truyền Hình", "Phim Truyện", "Giải Trí", "Thiếu Nhi", "Thể Thao")] == [
        100, 1050, 30, 30, 10]
    assert (row["active_contracts"], row["unique_devices"]) == (5, 6)
    assert (row["total_duration"], row["avg_session_duration"]) == (1220, 244.0)


def test_most_watch_keeps_ties(stats):
    got = {}
    for r in content.most_watch(stats).collect():
        got.setdefault(r["contract"], set()).add(r["most_watch"])
    assert got == {"c1": {"TV"}, "c2": {"Relax", "Child"}, "c4": {"Sport"}, "c5": {"Movie"},
                   "c3": {"Relax", "Movie", "Child", "Sport", "TV"}}


def test_most_watch_equals_rank_over_unpivoted(stats):
    ranked = content.unpivot_categories(stats).withColumn("r", F.expr(
        "rank() OVER (PARTITION BY contract, _load_date ORDER BY total_duration DESC)"))
    expected = ranked.where("r = 1").select("contract", F.col("category").alias("most_watch"), "_load_date")
    assert sorted(expected.collect()) == sorted(content.most_watch(stats).collect())


def test_taste(stats):
    assert as_dict(content.taste(stats), "contract", "taste") == {
        ("c1",): "Movie-TV", ("c2",): "Relax-Child", ("c3",): "", ("c4",): "Sport", ("c5",): "Movie"}


def test_contract_type(stats):
    assert content.usage_quartiles(content.viewing_totals(stats)).collect() == [
        Row(_load_date=DAY, q1=60, q3=150)]
    got = {r["contract"]: (r["total_duration"], r["type"]) for r in content.contract_type(stats).collect()}
    assert got == {"c1": (150, "Medium"), "c2": (60, "Medium"), "c3": (70, "Medium"),
                   "c4": (10, "Low"), "c5": (1000, "High")}


@pytest.mark.parametrize("spread", [50, 5_000_000, 2**40])
def test_quantiles_equal_percentile_disc(spark, spread):
    rng = random.Random(spread)
    rows = [(f"d{day}", rng.randrange(-spread, spread) if rng.random() < .5 else rng.randrange(3))
            for day in range(12) for _ in range(1 + day * day)]
    rows += [("empty", None), ("one", 7)]
    df = spark.createDataFrame(rows, "g string, x long")
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "q3": 0.75, "hi": 1.0}
    got = discrete_quantiles(df, "g", "x", probs).collect()
    exact = df.where("x IS NOT NULL").groupBy("g").agg(*[
        F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)").cast("long").alias(n)
        for n, p in probs.items()]).collect()
    assert sorted(got) == sorted(exact)


def test_quantiles_equal_approx_quantile_without_error(spark):
    rng = random.Random(5)
    for size in (1, 2, 3, 4, 5, 7, 8, 41, 100):
        df = spark.createDataFrame([("d", rng.randrange(60)) for _ in range(size)], "g string, x long")
        row = discrete_quantiles(df, "g", "x", {"a": 0.25, "b": 0.75}).first()
        assert [row["a"], row["b"]] == df.approxQuantile("x", [0.25, 0.75], 0.0)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], CONTRACT_STATS)
    assert content.contract_type(empty).collect() == []


HISTORY = [("a", "2022-04-01"), ("a", "2022-04-03"), ("b", "2022-04-03"), ("a", "2022-04-06"),
           ("c", "2022-04-06")]


def test_activeness_modes(spark):
    df = stats_of(spark, HISTORY)
    columns = ("contract", "_load_date", "activeness")
    assert as_dict(content.activeness(df, "as_of"), *columns) == {
        ("a", "2022-04-01"): 1, ("a", "2022-04-03"): 2, ("b", "2022-04-03"): 1,
        ("a", "2022-04-06"): 3, ("c", "2022-04-06"): 1}
    assert as_dict(content.activeness(df, "prior"), *columns) == {
        ("a", "2022-04-03"): 1, ("a", "2022-04-06"): 2}
    assert set(as_dict(content.activeness(df, "snapshot"), *columns).values()) == {3, 1}
    assert as_dict(content.activeness_snapshot(df), *columns) == {
        ("a", "2022-04-06"): 3, ("b", "2022-04-06"): 1, ("c", "2022-04-06"): 1}
    with pytest.raises(ValueError):
        content.activeness(df, "other")


def test_activeness_carried_covers_everyone_seen(spark):
    got = as_dict(content.activeness_carried(stats_of(spark, HISTORY)),
                  "contract", "_load_date", "activeness")
    assert got == {
        ("a", "2022-04-01"): 1,
        ("a", "2022-04-03"): 2, ("b", "2022-04-03"): 1,
        ("a", "2022-04-06"): 3, ("b", "2022-04-06"): 1, ("c", "2022-04-06"): 1}


@pytest.mark.parametrize("mode", ["as_of", "prior", "carried"])
def test_activeness_of_a_range_counts_earlier_days(spark, mode):
    whole, cut = stats_of(spark, HISTORY), "2022-04-03"
    inside = whole.where(F.col("_load_date") >= cut)
    before = whole.where(F.col("_load_date") < cut)
    run = (content.activeness_carried if mode == "carried"
           else lambda df, earlier=None: content.activeness(df, mode, earlier))
    expected = run(whole).where(F.col("_load_date") >= cut).collect()
    assert sorted(run(inside, before).collect()) == sorted(expected)


def test_clinginess_table(spark):
    cases = {("Low", 10): "Low", ("Low", 20): "Low", ("Low", 21): "Medium", ("Medium", 10): "Low",
             ("Medium", 11): "Medium", ("Medium", 20): "Medium", ("Medium", 21): "High",
             ("High", 10): "Medium", ("High", 11): "High", ("High", 21): "High"}
    rows = [(f"c{i}", DAY, t, a) for i, (t, a) in enumerate(cases)]
    df = spark.createDataFrame(rows, "contract string, _load_date string, type string, activeness long")
    got = content.clinginess(df.drop("activeness"), df.drop("type"))
    assert as_dict(got, "type", "activeness", "clinginess") == cases


def test_clinginess_needs_both_sides(spark):
    types = spark.createDataFrame([("x", DAY, "Low"), ("y", DAY, "Low")],
                                  "contract string, _load_date string, type string")
    active = spark.createDataFrame([("y", DAY, 3), ("z", DAY, 3)],
                                   "contract string, _load_date string, activeness long")
    assert [r["contract"] for r in content.clinginess(types, active).collect()] == ["y"]


def test_range_is_the_union_of_its_days(spark):
    rng = random.Random(3)
    apps = ["CHANNEL", "VOD", "RELAX", "CHILD", "SPORT", "??", None]
    days = [f"2022-04-{d:02d}" for d in range(1, 5)]
    frames = [bronze(spark, [(f"c{rng.randrange(9)}", f"m{rng.randrange(9)}", rng.choice(apps),
                              rng.randrange(100)) for _ in range(60)], day) for day in days]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    for build in (content.contract_stats,
                  lambda e: content.contract_type(content.contract_stats(e)),
                  lambda e: content.most_watch(content.contract_stats(e)),
                  lambda e: content.daily_summary(content.contract_stats(e), content.platform_devices(e))):
        single = [r for f in frames for r in build(content.enrich(f)).collect()]
        assert sorted(single) == sorted(build(content.enrich(whole)).collect())
        shuffled = whole.orderBy(F.rand(7)).repartition(5)
        assert sorted(build(content.enrich(shuffled)).collect()) == sorted(single)
