"""Days that fail alone, their ledger and their retry; gold views in the catalog."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from test_plans import DAYS, drop_content, layers_of, roots, rows_of  # noqa: F401
from viewstats.plans import catalog, chain, failures, silver
from viewstats.sources.layers import read_table
from viewstats.sources.paths import stored_days, table_path
from viewstats.sources.sinks import write_days

FOUR = [*DAYS, "2022-04-05"]


def days_in(spark, root, name):
    return stored_days(spark, table_path(root, "content", name))


def test_one_unreadable_day_of_four(spark, roots):
    drop_content(roots["drop"], [d for d in FOUR if d != DAYS[1]], rows=12)
    bad = f"{roots['raw']}/content/_load_date={DAYS[1]}"
    os.makedirs(bad)
    with open(f"{bad}/20220402.json.gz", "w") as f:  # no gzip file
        f.write("not compressed\n")
    layers = layers_of(roots)
    with pytest.raises(failures.DaysFailed, match=f"bronze {DAYS[1]}") as caught:
        chain.run(spark, layers, mode="date_range", start=FOUR[0], end=FOUR[3], on_failure="hold")
    assert [(f.layer, f.day) for f in caught.value.failures] == [("bronze", DAYS[1])]
    good = [d for d in FOUR if d != DAYS[1]]
    assert days_in(spark, roots["bronze"], None) == good
    assert days_in(spark, roots["silver"], "contract_clinginess") == good
    assert stored_days(spark, f"{roots['gold']}/gold_kpi_metrics", "date") == good
    open_now = failures.open_days(spark, layers.failures, "content")
    assert [(r["layer"], r["day"]) for r in open_now.collect()] == [("bronze", DAYS[1])]
    assert failures.open_days(spark, layers.failures, "search").count() == 0

    os.remove(f"{bad}/20220402.json.gz")
    drop_content(roots["drop"], [DAYS[1]], rows=12)
    assert chain.retry(spark, layers, "content").count() == 4
    assert failures.open_days(spark, layers.failures, "content").count() == 0
    assert chain.retry(spark, layers, "content") is None
    # As if no day had ever failed: later days count the one that came late.
    fresh = f"{roots['silver']}-fresh"
    silver.run(spark, roots["bronze"], fresh)
    for name in ("contract_activeness", "daily_summary"):
        assert rows_of(read_table(spark, roots["silver"], "content", name)) == rows_of(
            read_table(spark, fresh, "content", name))


def job_failing_on(bad, done, days):
    def job(start, end):
        inside = [d for d in days if (start is None or d >= start) and (end is None or d <= end)]
        if set(inside) & set(bad):
            raise OSError("unreadable")
        done.append((start, end, inside))
        return inside
    return job


@pytest.mark.parametrize("bad", [[], [0], [5], [15], [3, 4], [0, 7, 15]])
def test_halving(bad):
    days = [f"2022-04-{d:02d}" for d in range(1, 17)]
    lost, done = [days[i] for i in bad], []
    results, found = failures.by_range(job_failing_on(lost, done, days), "bronze", days)
    assert [f.day for f in found] == lost
    assert [d for r in results for d in r] == [d for d in days if d not in lost]
    # Open ends stay open, and each day but the bad ones is in exactly one range.
    if bad:
        assert min(s or "" for s, _, _ in done) == "" and None in [e for _, e, _ in done]
    covered = sorted(d for _, _, inside in done for d in inside)
    assert covered == [d for d in days if d not in lost] and len(done) <= 1 + 5 * len(bad)


def test_too_many_failing_days_and_other_errors_end_the_run():
    days = [f"2022-04-{d:02d}" for d in range(1, 31)]
    with pytest.raises(failures.DaysFailed):
        failures.by_range(job_failing_on(days, [], days), "bronze", days)

    def wrong(start, end):
        raise ValueError("a mistake in the call")
    with pytest.raises(ValueError):
        failures.by_range(wrong, "bronze", days)
    with pytest.raises(ValueError, match="on_failure"):
        chain.run(None, None, on_failure="ignore")


def test_ledger_goes_by_the_last_entry(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert failures.open_days(spark, ledger, "content").count() == 0
    failures.record(spark, ledger, "content", "bronze", [("2022-04-01", failures.FAILED, "a"), ("2022-04-02", failures.FAILED, "b")])
    failures.record(spark, ledger, "content", "bronze", [("2022-04-01", failures.DONE, None)])
    failures.record(spark, ledger, "content", "silver", [("2022-04-01", failures.FAILED, "c")])
    failures.record(spark, ledger, "content", "bronze", [])
    rows = failures.open_days(spark, ledger, "content").orderBy("day").collect()
    assert [(r["layer"], r["day"], r["error"]) for r in rows] == [("silver", "2022-04-01", "c"), ("bronze", "2022-04-02", "b")]


def test_views_outlive_the_session(spark, roots):
    drop_content(roots["drop"], DAYS[:2], rows=12)
    rows = [("u1", "vtv", "2022-06-03"), ("u1", "naruto", "2022-07-03")]
    write_days(spark.createDataFrame(rows, "user_id string, keyword string, _load_date string"),
               table_path(roots["raw"], "search"))
    layers = layers_of(roots)
    chain.run(spark, layers, mode="full", database="viewstats_test")
    search_layers = chain.Roots(layers.raw, layers.bronze, layers.silver, layers.gold)
    chain.run(spark, search_layers, "search", mode="full", database="viewstats_test")
    other = spark.newSession()
    assert {r["viewName"] for r in other.sql("SHOW VIEWS IN viewstats_test").collect() if not r["isTemporary"]} == set(catalog.MODELS)
    for name in catalog.MODELS:
        view = other.table(f"viewstats_test.{name}")
        assert rows_of(view) == rows_of(spark.read.parquet(f"{roots['gold']}/{name}")), name
    assert other.sql("SELECT max(active_contracts) AS n FROM viewstats_test.gold_kpi_metrics").first()["n"] > 0
    assert sorted(str(r["date"]) for r in catalog.days(other, "contract_taste", "viewstats_test").collect()) == DAYS[:2]
    # Files that a run is still adding are not seen through a view.
    stored = spark.read.parquet(f"{roots['gold']}/contract_taste")
    write_days(stored, f"{roots['gold']}/contract_taste", "date", append=True)
    assert other.table("viewstats_test.contract_taste").count() * 2 == spark.read.parquet(f"{roots['gold']}/contract_taste").count()


def test_views_of_models_that_are_gone_are_dropped(spark, tmp_path):
    root = str(tmp_path / "gold")
    frame = spark.createDataFrame([("c", "2022-04-01", "x'y")], "contract string, date string, taste string")
    write_days(frame, f"{root}/contract_taste", "date")
    assert catalog.publish(spark, f"{root}/", "viewstats_gone") == ["contract_taste"]
    assert spark.table("viewstats_gone.contract_taste").select("taste").first()[0] == "x'y"
    assert catalog.publish(spark, str(tmp_path / "none"), "viewstats_gone") == []
    with pytest.raises(AnalysisException):
        spark.table("viewstats_gone.contract_taste")
