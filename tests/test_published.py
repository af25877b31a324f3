"""Tables that change together: runs that fail, runs that die, and readers in between."""

import os

import pytest
from pyspark.sql import functions as F

from test_plans import DAYS, TABLES, drop_content, roots, rows_of, through_bronze  # noqa: F401
from viewstats.operators import gold as gold_models
from viewstats.plans import bronze, gold, landing, silver
from viewstats.sources import published
from viewstats.sources.layers import read_history, read_last_day, read_table
from viewstats.sources.paths import delete_path, table_path
from viewstats.sources.published import Publication
from viewstats.schemas import CONTRACT_STATS

MODELS = ["gold_kpi_metrics", *gold_models.CONTRACT_MODELS]


class Killed(BaseException):
    """The process dies: nothing that would clear up runs."""


def state_of(spark, roots):
    return {name: rows_of(read_table(spark, roots["silver"], "content", name)) for name in TABLES}


def new_bronze(spark, roots):
    """Other rows for two of the three days, and one day less."""
    for day in DAYS:
        os.remove(f"{roots['drop']}/{day.replace('-', '')}.json")
    drop_content(roots["drop"], DAYS[1:], rows=60)
    landing.land(spark, roots["drop"], roots["raw"])
    delete_path(spark, table_path(roots["raw"], "content", day=DAYS[0]))
    bronze.run(spark, roots["raw"], roots["bronze"], "content")


def die_at(monkeypatch, table, cleared=False):
    write = Publication.write

    def killed(self, name, *args, **kwargs):
        if name == table:
            raise Killed
        write(self, name, *args, **kwargs)

    monkeypatch.setattr(Publication, "write", killed)
    if not cleared:
        monkeypatch.setattr(Publication, "abandon", lambda self: None)


@pytest.mark.parametrize("cleared", [True, False])
def test_a_run_that_ends_between_two_tables_changes_none(spark, roots, monkeypatch, cleared):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    old = state_of(spark, roots)
    new_bronze(spark, roots)
    with monkeypatch.context() as patch:
        die_at(patch, "contract_activeness", cleared)
        with pytest.raises(Killed):
            silver.run(spark, roots["bronze"], roots["silver"])
    assert os.path.exists(f"{roots['silver']}/content/{published.BEFORE}") != cleared
    assert state_of(spark, roots) == old
    last = read_last_day(spark, roots["silver"], "contract_stats", DAYS[2])
    assert {r[0] for r in last.select("_load_date").collect()} == {DAYS[1]}
    silver.run(spark, roots["bronze"], roots["silver"])
    fresh = f"{roots['silver']}-fresh"
    silver.run(spark, roots["bronze"], fresh)
    for name in TABLES:
        stored = spark.read.parquet(f"{roots['silver']}/content/{name}")  # nothing else is left in the folder
        assert rows_of(stored) == rows_of(spark.read.parquet(f"{fresh}/content/{name}")), name
    assert not [n for n in os.listdir(f"{roots['silver']}/content") if n.startswith("_")]


def test_a_first_run_that_dies_leaves_no_tables(spark, roots, monkeypatch):
    through_bronze(spark, roots)
    with monkeypatch.context() as patch:
        die_at(patch, "daily_summary")
        with pytest.raises(Killed):
            silver.run(spark, roots["bronze"], roots["silver"])
    assert gold.run(spark, roots["silver"], roots["gold"]) is None
    assert gold.register_sources(spark, roots["silver"]) == []
    assert read_history(spark, roots["silver"], "contract_stats", CONTRACT_STATS).count() == 0
    silver.run(spark, roots["bronze"], roots["silver"])
    assert gold.run(spark, roots["silver"], roots["gold"]).count() == 3


def test_a_published_run_that_dies_before_clearing_up_is_read_whole(spark, roots, monkeypatch):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    new_bronze(spark, roots)
    with monkeypatch.context() as patch:
        patch.setattr(published, "_clear", lambda *args: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            silver.run(spark, roots["bronze"], roots["silver"])
    new = state_of(spark, roots)
    published.settle(spark, f"{roots['silver']}/content")
    assert state_of(spark, roots) == new
    assert {r[0] for r in read_table(spark, roots["silver"], "content", "daily_summary").select("_load_date").collect()} == {*DAYS[1:]}


def test_gold_models_change_together(spark, roots, monkeypatch):
    through_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    gold.run(spark, roots["silver"], roots["gold"])
    read = lambda: {name: rows_of(published.read(spark, roots["gold"], name) or spark.read.parquet(f"{roots['gold']}/{name}"))
                    for name in MODELS}
    old = read()
    new_bronze(spark, roots)
    silver.run(spark, roots["bronze"], roots["silver"])
    with monkeypatch.context() as patch:
        die_at(patch, "contract_type")
        with pytest.raises(Killed):
            gold.run(spark, roots["silver"], roots["gold"])
    assert read() == old
    gold.run(spark, roots["silver"], roots["gold"])
    assert read() != old


def test_ranges_and_days_that_go(spark, tmp_path):
    folder = str(tmp_path / "tables")
    frame = lambda value, *days: spark.createDataFrame([(value, d) for d in days], "v int, _load_date string")
    with Publication(spark, folder, ["a", "b"]) as run:
        run.write("a", frame(1, *DAYS))
        run.write("b", frame(1, *DAYS))
        run.publish()
    with Publication(spark, folder, ["a", "b"]) as run:
        run.write("a", frame(2, DAYS[1]))
        assert [r[0] for r in run.read("a").collect()] == [2]
        assert rows_of(published.read(spark, folder, "a").select("v")) == ["Row(v=1)"] * 3
        run.publish(DAYS[1], DAYS[2])
    values = lambda t: sorted((r["v"], str(r["_load_date"])) for r in spark.read.parquet(f"{folder}/{t}").collect())
    assert values("a") == [(1, DAYS[0]), (2, DAYS[1])] and values("b") == [(1, DAYS[0])]
    with Publication(spark, folder, ["a"]) as run:
        run.write("a", frame(3, DAYS[2]))
        run.publish_written()
    assert values("a") == [(1, DAYS[0]), (2, DAYS[1]), (3, DAYS[2])]
    with pytest.raises(RuntimeError, match="without publish"):
        with Publication(spark, folder, ["a"]) as run:
            run.write("a", frame(4, DAYS[2]))
    assert values("a") == [(1, DAYS[0]), (2, DAYS[1]), (3, DAYS[2])]
    with Publication(spark, folder, ["a", "b"]) as run:
        run.write("a", frame(5, DAYS[0]).where(F.lit(False)))
        run.publish()
    assert not os.path.exists(f"{folder}/a") and not os.path.exists(f"{folder}/b")


def test_two_runs_at_once_are_refused(spark, tmp_path):
    folder = str(tmp_path / "tables")
    one, two = Publication(spark, folder, ["a"]), Publication(spark, folder, ["a"])
    with one:
        with pytest.raises(RuntimeError, match="another run"):
            two.__enter__()
        one.publish()
