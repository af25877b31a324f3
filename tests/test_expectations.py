import pytest

from viewstats.operators import expectations, gold


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "Changed"), ("a", None, "Unchanged"), (None, 2, "Odd"), ("b", 2, None)],
        "k string, v int, trending_type string")


def test_not_null(table):
    got = {r["column_name"]: r["failures"] for r in expectations.not_null(table, ["k", "v"]).collect()}
    assert got == {"k": 1, "v": 1}


def test_unique(table):
    assert expectations.unique(table, "k").first()["failures"] == 1


def test_accepted_values(table):
    check = expectations.accepted_values(table, "trending_type", expectations.TRENDING_VALUES)
    assert check.first()["failures"] == 1
    with pytest.raises(expectations.ExpectationError, match="accepted_values"):
        expectations.require(expectations.unique(table, "v"), check)


def test_require_passes_clean_tables(table):
    clean = table.where("k = 'b'")
    expectations.require(expectations.not_null(clean, ["k", "v"]), expectations.unique(clean, "k"))


def test_reconcile_finds_a_mismatch(spark):
    stats = spark.createDataFrame([("c1", "2022-04-01"), (" c1 ", "2022-04-01"), ("c2", "2022-04-02")],
                                  "contract string, _load_date string")
    summary = spark.createDataFrame([("2022-04-01", 2), ("2022-04-02", 1)],
                                    "_load_date string, active_contracts long")
    got = {r["_load_date"]: (r["total_dau"], r["matches"])
           for r in expectations.contracts_reconcile(stats, summary).collect()}
    assert got == {"2022-04-01": (1, 0), "2022-04-02": (1, 1)}
    assert expectations.contracts_reconcile(stats, summary, "2022-04-02").count() == 1


def test_kpi_average_is_guarded(spark):
    summary = spark.createDataFrame(
        [("2022-04-01", 5, None, 0, 0, 0, 0, None)],
        "_load_date string, `Truyền Hình` long, `Phim Truyện` long, `Giải Trí` long, "
        "`Thiếu Nhi` long, `Thể Thao` long, active_contracts long, unique_devices long")
    row = gold.kpi_metrics(summary).first()
    assert (row["total_duration"], row["avg_session_duration"], row["unique_devices"]) == (5, 0.0, 0)


def test_user_id_is_cut_to_fifty(spark):
    df = spark.createDataFrame([("u" * 60, "a", "b", "c", "d", "Changed", "x")],
                               "user_id string, most_search_june string, category_june string, "
                               "most_search_july string, category_july string, trending_type string, "
                               "previous string")
    assert len(gold.search_trending(df).first()["user_id"]) == 50
