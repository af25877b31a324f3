"""Whole layer jobs over files: landing, bronze, silver, gold, re-runs and backfills."""

import json
import os
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from viewstats.functions import month_bounds, run_date
from viewstats.operators import content, gold as gold_models, quality
from viewstats.operators.expectations import ExpectationError
from viewstats.plans import bronze, chain, gold, landing, ranges, silver
from viewstats.schemas import CONTRACT_STATS
from viewstats.sources.layers import or_missing, read_day, read_history, read_table
from viewstats.sources.paths import delete_path, quarantine_path, table_path
from viewstats.sources.raw import read_content, read_drop, read_raw, undated_files
from viewstats.sources.sinks import write_days

CODES = ["CHANNEL", "VOD", "RELAX", "CHILD", "SPORT", "OTHER"]


def line(i, contract="c", mac="m", duration=10, app="VOD"):
    return json.dumps({"_id": f"i{i}", "_source": {
        "Contract": contract, "Mac": mac, "TotalDuration": duration, "AppName": app}})


def drop_content(folder, days, rows=40, bad=0):
    os.makedirs(folder, exist_ok=True)
    for n, day in enumerate(days):
        lines = [line(f"{day}-{i}", f"c{i % (7 + n)}", f"m{i % 5}", 10 * i, CODES[(i + n) % 6])
                 for i in range(rows)]
        lines += ["garbage"] * bad
        with open(f"{folder}/{day.replace('-', '')}.json", "w") as f:
            f.write("\n".join(lines) + "\n")


@pytest.fixture
def roots(tmp_path):
    return {k: str(tmp_path / k) for k in ("drop", "raw", "bronze", "silver", "gold")}


DAYS = ["2022-04-01", "2022-04-02", "2022-04-04"]


def through_bronze(spark, roots, days=DAYS, **kwargs):
    drop_content(roots["drop"], days, **kwargs)
    landing.land(spark, roots["drop"], roots["raw"], "content")
    return bronze.run(spark, roots["raw"], roots["bronze"], "content")


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_raw_lines(spark, roots):
    day_dir = table_path(roots["raw"], "content", day="2022-04-01")
    os.makedirs(day_dir)
    lines = [line(1), '{"_id": "i2", "extra": 1, "_source": {"Contract": "c", "Other": [1]}}', "garbage",
             "", '{"_id": "i3"}', '{"_id": "i4", "_source": {"TotalDuration": "12"}}',
             '{"_id": "i5", "_source": {"TotalDuration": 1.5}}']
    with open(f"{day_dir}/20220401.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    rows = read_content(spark, roots["raw"]).collect()
    by_id = {r["_id"]: r for r in rows}
    assert len(rows) == 7 and sum(r["_id"] is None for r in rows) == 2
    assert by_id["i1"]["total_duration"] == 10 and by_id["i2"]["contract"] == "c"
    assert all(by_id[i]["total_duration"] is None for i in ("i3", "i4", "i5"))
    assert {r["_load_date"] for r in rows} == {"2022-04-01"}
    _, rejected = quality.split(quality.dedup_by_id(read_content(spark, roots["raw"])), quality.content_rules())
    assert rejected.where("_id IS NULL").count() == 2


def test_landing_content(spark, roots):
    drop_content(roots["drop"], DAYS, rows=3)
    with open(f"{roots['drop']}/notes.txt", "w") as f:
        f.write("not a day file\n")
    landing.land(spark, roots["drop"], roots["raw"], "content", start="2022-04-02")
    got = read_raw(spark, roots["raw"]).groupBy("_load_date").count().collect()
    assert sorted(map(tuple, got)) == [("2022-04-02", 3), ("2022-04-04", 3)]


def test_landing_search(spark, roots):
    for day, user in (("20220601", "u1"), ("20220602", "u2")):
        spark.createDataFrame([(user, "k", 1)], "user_id string, keyword string, extra int").write.parquet(
            f"{roots['drop']}/{day}")
    for _ in range(2):
        landing.land(spark, roots["drop"], roots["raw"], "search")
    rows = read_raw(spark, roots["raw"], "search").select("user_id", "extra", "_load_date").collect()
    assert sorted(map(tuple, rows)) == [("u1", 1, "2022-06-01"), ("u2", 1, "2022-06-02")]


def test_nothing_to_do(spark, roots):
    assert landing.land(spark, roots["drop"], roots["raw"]) is None
    assert bronze.run(spark, roots["raw"], roots["bronze"]) is None
    assert silver.run(spark, roots["bronze"], roots["silver"]) is None
    assert silver.run(spark, roots["bronze"], roots["silver"], "search") is None
    assert silver.backfill_most_watch_taste(spark, roots["silver"]) is None
    empty = read_history(spark, roots["silver"], "contract_stats", CONTRACT_STATS)
    assert empty.count() == 0 and empty.schema == CONTRACT_STATS
    assert gold.register_sources(spark, roots["silver"]) == []


def test_other_errors_are_raised(spark):
    with pytest.raises(AnalysisException):
        or_missing(lambda: spark.range(1).select("no_such_column"))


def test_unknown_types_and_modes(spark, roots):
    for call in (lambda: read_raw(spark, "x", "video"), lambda: read_drop(spark, "x", "video"),
                 lambda: bronze.run(spark, "x", "y", "video"), lambda: silver.run(spark, "x", "y", "video"),
                 lambda: gold.run(spark, "x", "y", "video"), lambda: ranges.day_range("weekly"),
                 lambda: bronze.run(spark, "x", "y", on_exceeded="ignore")):
        with pytest.raises(ValueError):
            call()


def test_bronze_report_and_reruns(spark, roots):
    for _ in range(2):
        report = through_bronze(spark, roots, bad=2)
    assert {r["_load_date"]: (r["valid"], r["invalid"]) for r in report} == {d: (40, 2) for d in DAYS}
    assert read_table(spark, roots["bronze"], "content").count() == 120
    assert read_table(spark, roots["bronze"], "content_quarantine").count() == 6
    assert read_day(spark, roots["bronze"], "content", "2022-04-02").count() == 40


def test_rerun_without_rejects_empties_the_quarantine(spark, roots):
    through_bronze(spark, roots, bad=2)
    drop_content(roots["drop"], ["2022-04-02"], bad=0)
    landing.land(spark, roots["drop"], roots["raw"], start="2022-04-02", end="2022-04-02")
    bronze.run(spark, roots["raw"], roots["bronze"], start="2022-04-02", end="2022-04-02")
    days = read_table(spark, roots["bronze"], "content_quarantine").groupBy("_load_date").count().collect()
    assert sorted(map(tuple, days)) == [("2022-04-01", 2), ("2022-04-04", 2)]


def test_gate_publishes_nothing_by_default(spark, roots):
    drop_content(roots["drop"], DAYS[:2])
    drop_content(roots["drop"], DAYS[2:], bad=5)
    landing.land(spark, roots["drop"], roots["raw"])
    with pytest.raises(quality.QualityGateError, match="2022-04-04"):
        bronze.run(spark, roots["raw"], roots["bronze"])
    assert not os.path.exists(table_path(roots["bronze"], "content"))
    report = bronze.run(spark, roots["raw"], roots["bronze"], on_exceeded="hold")
    assert [r["_load_date"] for r in bronze.held(report)] == ["2022-04-04"]
    assert read_table(spark, roots["bronze"], "content").select("_load_date").distinct().count() == 2


def test_staged_rows_are_removed(spark, roots):
    through_bronze(spark, roots)
    drop_content(roots["drop"], DAYS[:1], bad=9)
    landing.land(spark, roots["drop"], roots["raw"])
    with pytest.raises(quality.QualityGateError):
        bronze.run(spark, roots["raw"], roots["bronze"])
    assert sorted(os.listdir(roots["bronze"])) == ["content", "content_quarantine"]


def test_search_bronze_keeps_extra_columns_and_duplicates(spark, roots):
    rows = [("u", "k", 1)] * 4 + [(None, "k", 2)]
    spark.createDataFrame(rows, "user_id string, keyword string, extra int").write.parquet(
        table_path(roots["raw"], "search", day="2022-06-01"))
    bronze.run(spark, roots["raw"], roots["bronze"], "search")
    stored = read_table(spark, roots["bronze"], "search")
    assert stored.count() == 4 and "extra" in stored.columns
    assert read_table(spark, roots["bronze"], "search_quarantine").count() == 1


def test_search_columns_may_differ_between_days(spark, roots):
    for day, extra in (("2022-06-01", "a"), ("2022-06-02", "b")):
        spark.createDataFrame([("u", "k", 1)], f"user_id string, keyword string, {extra} int").write.parquet(
            table_path(roots["raw"], "search", day=day))
    for day in ("2022-06-01", "2022-06-02"):  # one run each
        bronze.run(spark, roots["raw"], roots["bronze"], "search", start=day, end=day)
    stored = read_table(spark, roots["bronze"], "search").select("a", "b", "_load_date").collect()
    assert sorted(map(str, stored)) == [
        "Row(a=1, b=None, _load_date='2022-06-01')", "Row(a=None, b=1, _load_date='2022-06-02')"]


TABLES = ["contract_stats", "daily_summary", "contract_most_watch", "contract_taste",
          "contract_type", "contract_activeness", "contract_clinginess"]


def test_silver_ranges_equal_one_job(spark, roots, tmp_path):
    through_bronze(spark, roots)
    parts, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    silver.run(spark, roots["bronze"], whole)
    for day in DAYS:
        silver.run(spark, roots["bronze"], parts, start=day, end=day)
    silver.run(spark, roots["bronze"], parts, start=DAYS[1], end=DAYS[2])
    for name in TABLES:
        left, right = (read_table(spark, root, "content", name) for root in (parts, whole))
        assert rows_of(left) == rows_of(right), name
    lazy = silver.content_tables(read_table(spark, roots["bronze"], "content"))
    for name in TABLES:
        stored = read_table(spark, whole, "content", name)
        assert rows_of(stored) == rows_of(lazy[name]), name


def test_backfill_most_watch_taste(spark, roots):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    before = rows_of(read_table(spark, roots["silver"], "content", "contract_taste"))
    days = silver.backfill_most_watch_taste(spark, roots["silver"], DAYS[1], DAYS[2])
    assert sorted(r["_load_date"] for r in days.collect()) == DAYS[1:]
    assert rows_of(read_table(spark, roots["silver"], "content", "contract_taste")) == before


def test_gold_content(spark, roots):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    kpis = gold.run(spark, roots["silver"], roots["gold"], "content")
    assert [r["date"] for r in kpis.orderBy("date").collect()] == [date.fromisoformat(d) for d in DAYS]
    assert set(gold.register_sources(spark, roots["silver"])) == set(gold.SILVER_SOURCES) - {"search_trending"}
    assert spark.sql("SELECT count(DISTINCT contract) AS n FROM silver_contract_stats").first()["n"] == 9
    single = f"{roots['gold']}-single"
    for name in ("contract_most_watch", "contract_activeness"):
        gold.run_contract_model(spark, name, roots["silver"], single)
        first = rows_of(spark.read.parquet(f"{single}/{name}"))
        assert first == rows_of(spark.read.parquet(f"{roots['gold']}/{name}"))
        again = gold.run_contract_model(spark, name, roots["silver"], single, "2022-04-02T02:00:00")
        assert rows_of(again) == first
        with pytest.raises(ValueError):
            gold.run_contract_model(spark, name, roots["silver"], single)


def test_search_to_gold(spark, roots):
    rows = [("u1", "vtv", "2022-06-03"), ("u1", "naruto", "2022-07-03"), ("u2", "vtv", "2022-07-04")]
    df = spark.createDataFrame(rows, "user_id string, keyword string, _load_date string")
    write_days(df, table_path(roots["bronze"], "search"))
    for _ in range(2):
        silver.run(spark, roots["bronze"], roots["silver"], "search")
    assert [r["previous"] for r in gold.run(spark, roots["silver"], roots["gold"], "search").collect()] == ["TV; Anime"]


def test_paths():
    assert table_path("/r/", "content", "contract_stats", "2022-04-01T00:00:00") == \
        "/r/content/contract_stats/_load_date=2022-04-01"
    assert table_path("/r", "search") == "/r/search"
    assert quarantine_path("/r", "search") == "/r/search_quarantine"


def test_dates():
    assert run_date("2022-04-01T02:00:00+00:00") == run_date("2022-04-01") == run_date(date(2022, 4, 1))
    assert month_bounds("2022-12") == ("2022-12-01", "2023-01-01")
    assert ranges.day_range(today="2022-05-01") == ("2022-04-30", "2022-04-30")
    assert ranges.day_range("date_range", "2022-04-01", "2022-04-03") == ("2022-04-01", "2022-04-03")
    assert ranges.day_range("full") == (None, None)


def test_partition_pruning(spark, roots):
    through_bronze(spark, roots)
    plan = read_day(spark, roots["bronze"], "content", DAYS[0])._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(_load_date" in plan.toString()


def test_most_watch_of_a_stored_day_needs_no_shuffle(spark, roots):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    stats = read_table(spark, roots["silver"], "content", "contract_stats")
    for df in (content.most_watch(stats), content.taste(stats), content.unpivot_categories(stats)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_full_run_drops_days_that_bronze_lost(spark, roots, tmp_path):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    smaller = str(tmp_path / "smaller")
    write_days(read_day(spark, roots["bronze"], "content", DAYS[0]), table_path(smaller, "content"))
    silver.run(spark, smaller, roots["silver"], start=DAYS[0], end=DAYS[0])
    assert read_table(spark, roots["silver"], "content", "daily_summary").count() == 3
    silver.run(spark, smaller, roots["silver"])
    for name in TABLES:
        days = read_table(spark, roots["silver"], "content", name).select("_load_date").distinct()
        assert [r[0] for r in days.collect()] == [DAYS[0]], name


def layers_of(roots):
    return chain.Roots(roots["raw"], roots["bronze"], roots["silver"], roots["gold"], roots["drop"])


MODELS = ["gold_kpi_metrics", *gold_models.CONTRACT_MODELS]


def test_chain(spark, roots):
    drop_content(roots["drop"], DAYS)
    layers = layers_of(roots)
    assert chain.run(spark, layers, today="2022-04-02").count() == 1
    assert chain.run(spark, layers, today="2022-04-04") is None  # 2022-04-03 has no file
    assert chain.run(spark, layers, mode="date_range", start=DAYS[1], end=DAYS[2]).count() == 3
    assert chain.run(spark, layers, mode="full").count() == 3
    other = spark.newSession()  # gold outlives the session that built it
    for name in MODELS:
        stored = other.read.parquet(f"{roots['gold']}/{name}")
        assert stored.select("date").distinct().count() == 3, name


def test_hold_goes_on_and_raises_last(spark, roots):
    days = [*DAYS, "2022-04-05"]
    drop_content(roots["drop"], days)
    drop_content(roots["drop"], DAYS[1:2], bad=9)
    with pytest.raises(quality.QualityGateError, match=DAYS[1]):
        chain.run(spark, layers_of(roots), mode="full", on_exceeded="hold")
    good = [d for d in days if d != DAYS[1]]
    for root, name in (("silver", "contract_clinginess"), ("silver", "daily_summary")):
        stored = read_table(spark, roots[root], "content", name).select("_load_date").distinct().collect()
        assert sorted(r[0] for r in stored) == good
    kpis = spark.read.parquet(f"{roots['gold']}/gold_kpi_metrics")
    assert sorted(str(r["date"]) for r in kpis.collect()) == good


def emptied(spark, roots, mode, **days):
    """All layers filled, then the raw file of the second day gone, then run again."""
    drop_content(roots["drop"], DAYS)
    chain.run(spark, layers_of(roots), mode="full")
    active = read_day(spark, roots["silver"], "content", DAYS[2], table="contract_activeness")
    before = active.agg(F.sum("activeness")).first()[0]
    delete_path(spark, table_path(roots["raw"], "content", day=DAYS[1]))
    os.remove(f"{roots['drop']}/{DAYS[1].replace('-', '')}.json")
    chain.run(spark, layers_of(roots), mode=mode, **days)
    return before


@pytest.mark.parametrize("mode", ["full", "date_range"])
def test_a_day_that_raw_lost_leaves_every_layer(spark, roots, mode):
    days = {} if mode == "full" else {"start": DAYS[1], "end": DAYS[2]}
    before = emptied(spark, roots, mode, **days)
    left = [DAYS[0], DAYS[2]]
    tables = [(roots["bronze"], None)] + [(roots["silver"], name) for name in TABLES]
    for root, name in tables:
        stored = read_table(spark, root, "content", name).select("_load_date").distinct().collect()
        assert sorted(r[0] for r in stored) == left, name
    for name in MODELS:
        stored = spark.read.parquet(f"{roots['gold']}/{name}").select("date").distinct().collect()
        assert sorted(str(r[0]) for r in stored) == left, name
    active = read_day(spark, roots["silver"], "content", DAYS[2], table="contract_activeness")
    assert active.agg(F.sum("activeness")).first()[0] < before


def test_held_day_keeps_what_was_published(spark, roots):
    through_bronze(spark, roots)
    drop_content(roots["drop"], DAYS[1:2], rows=50, bad=9)
    landing.land(spark, roots["drop"], roots["raw"])
    bronze.run(spark, roots["raw"], roots["bronze"], start=DAYS[0], end=DAYS[2], on_exceeded="hold")
    assert read_day(spark, roots["bronze"], "content", DAYS[1]).count() == 40
    bronze.run(spark, roots["raw"], roots["bronze"], on_exceeded="hold")
    assert read_day(spark, roots["bronze"], "content", DAYS[1]).count() == 0


def test_an_incremental_run_reads_one_earlier_day(spark, roots):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"], end=DAYS[1])
    earlier = silver._earlier(spark, roots["silver"], DAYS[2], "as_of")
    assert {f.split("_load_date=")[1][:10] for f in earlier.inputFiles()} == set(DAYS[:2])
    plan = earlier._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(_load_date" in plan and plan.count("FileScan") == 1
    counts = {r["contract"]: r[content.ACTIVE_DAYS] for r in earlier.collect()}
    stats = read_table(spark, roots["silver"], "content", "contract_stats", end=DAYS[1])
    expected = {r["contract"]: r["count"] for r in stats.groupBy("contract").count().collect()}
    assert counts == expected


@pytest.mark.parametrize("mode", ["prior", "snapshot"])
def test_silver_modes(spark, roots, mode):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"], mode=mode)
    stats = read_table(spark, roots["silver"], "content", "contract_stats")
    stored = read_table(spark, roots["silver"], "content", "contract_activeness")
    assert rows_of(stored) == rows_of(content.activeness(stats, mode))


def test_other_months_reach_gold(spark, roots):
    rows = [("u1", "vtv", "2023-01-03"), ("u1", "naruto", "2023-02-03")]
    df = spark.createDataFrame(rows, "user_id string, keyword string, _load_date string")
    write_days(df, table_path(roots["raw"], "search"))
    got = chain.run(spark, chain.Roots(roots["raw"], roots["bronze"], roots["silver"], roots["gold"]), "search",
                    mode="full", months=("2023-01", "2023-02"), labels=("jan", "feb"))
    assert [(r["most_search_jan"], r["category_feb"]) for r in got.collect()] == [("vtv", "Anime")]


def test_undated_files_are_listed(spark, roots):
    drop_content(roots["drop"], DAYS[:1])
    with open(f"{roots['drop']}/notes.txt", "w") as f:
        f.write("not a day file\n")
    listed = [r["path"] for r in undated_files(spark, roots["drop"]).collect()]
    assert len(listed) == 1 and listed[0].endswith("notes.txt")


def spoil(spark, roots, table, day, change):
    """Rewrites one stored silver day."""
    rows = change(read_day(spark, roots["silver"], "content", day, table=table))
    write_days(spark.createDataFrame(rows.collect(), rows.schema),
               table_path(roots["silver"], "content", table))


@pytest.fixture
def filled(spark, roots):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    return roots


def test_gold_fails_when_any_day_does_not_reconcile(spark, filled):
    spoil(spark, filled, "contract_stats", DAYS[1], lambda df: df.limit(3))
    gold.run(spark, filled["silver"], filled["gold"], start=DAYS[0], end=DAYS[0])
    for start, end in ((DAYS[0], DAYS[2]), (None, None), (DAYS[1], DAYS[1])):
        with pytest.raises(ExpectationError, match="contracts_reconcile"):
            gold.run(spark, filled["silver"], filled["gold"], start=start, end=end)


def test_gold_fails_when_the_summary_lacks_a_day(spark, filled):
    delete_path(spark, f"{table_path(filled['silver'], 'content', 'daily_summary')}/_load_date={DAYS[1]}")
    with pytest.raises(ExpectationError, match="contracts_reconcile"):
        gold.run(spark, filled["silver"], filled["gold"])


def test_gold_checks_every_row_it_writes(spark, filled):
    spoil(spark, filled, "contract_taste", DAYS[1],
          lambda df: df.withColumn("contract", F.lit(None).cast("string")))
    with pytest.raises(ExpectationError, match="not_null"):
        gold.run(spark, filled["silver"], filled["gold"])
    with pytest.raises(ExpectationError, match="not_null"):  # first build: the target day is not all
        gold.run_contract_model(spark, "contract_taste", filled["silver"], filled["gold"], DAYS[0])
    assert not os.path.exists(f"{filled['gold']}/contract_taste")
