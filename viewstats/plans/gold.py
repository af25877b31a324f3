"""Silver -> gold: build a model, check it, publish it."""

from pyspark.sql import DataFrame, SparkSession

from viewstats.operators import expectations, gold
from viewstats.operators.search import MONTH_LABELS
from viewstats.sources.layers import or_missing, read_table
from viewstats.sources.published import Publication, settle
from viewstats.sources.sinks import clear_range, write_days, write_table

DATE = "date"

# SQL name -> (data type, silver table).
SILVER_SOURCES = {
    "silver_contract_stats": ("content", "contract_stats"),
    "silver_daily_summary": ("content", "daily_summary"),
    "contract_most_watch": ("content", "contract_most_watch"),
    "contract_taste": ("content", "contract_taste"),
    "contract_type": ("content", "contract_type"),
    "contract_activeness": ("content", "contract_activeness"),
    "contract_clinginess": ("content", "contract_clinginess"),
    "search_trending": ("search", "search_trending"),
}


def register_sources(spark: SparkSession, silver_root: str) -> list[str]:
    """Expose every stored silver table to SQL; returns the names registered."""
    registered = []
    for name, (data_type, table) in SILVER_SOURCES.items():
        df = or_missing(lambda: read_table(spark, silver_root, data_type, table))
        if df is not None:
            df.createOrReplaceTempView(name)
            registered.append(name)
    return registered


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_incremental(spark: SparkSession, name: str, silver: DataFrame, path: str,
                            target_date=None) -> None:
    """First build: all days. Later builds: the target day only, replacing what it had.

    The rows that are checked are the rows that are written; a target day without rows loses its
    partition.
    """
    settle(spark, path.rsplit("/", 1)[0])  # of a run that died
    exists = or_missing(lambda: spark.read.parquet(path)) is not None
    if exists and target_date is None:
        raise ValueError(f"{name} exists: an incremental build needs a target date")
    rows = gold.contract_model(name, silver, target_date if exists else None)
    expectations.require(expectations.contract_checks(rows))
    write_days(rows, path, DATE)
    if exists:
        _clear_empty(spark, rows, path, target_date, target_date)


def _clear_empty(spark: SparkSession, rows: DataFrame, path: str, start, end) -> None:
    present = {str(r[0]) for r in rows.select(DATE).distinct().collect()}  # the days of one run
    clear_range(spark, path, present, start, end, DATE)


def model_path(gold_root: str, name: str) -> str:
    return f"{gold_root.rstrip('/')}/{name}"


def run(spark: SparkSession, silver_root: str, gold_root: str, data_type: str = "content",
        start=None, end=None, labels: tuple[str, str] = MONTH_LABELS) -> DataFrame | None:
    """Build, check and store the models of a data type for a range of days; their views are
    registered too. Returns the KPI or the trending model as stored, None without silver data.

    Every check looks at the rows that are then written, and all checks come before the first write:
    not-null and unique columns, and for content that each day's contracts reconcile. Days of the range
    without rows lose their partitions; without a start and an end a model is replaced whole. The content
    models change together: a run that fails or dies leaves all of them as they were.
    """
    if data_type == "content":
        return _run_content(spark, silver_root, gold_root, start, end)
    if data_type != "search":
        raise ValueError(f"Unknown data_type: {data_type}")
    silver = or_missing(lambda: read_table(spark, silver_root, "search", "search_trending"))
    if silver is None:
        return None
    model = gold.search_trending(silver, labels)
    expectations.require(expectations.trending_checks(model))
    path = model_path(gold_root, "gold_search_trending")
    write_table(model, path)
    return publish_view(spark.read.parquet(path), "gold_search_trending")


def _run_content(spark: SparkSession, silver_root: str, gold_root: str, start, end) -> DataFrame | None:
    def stored_silver(table):
        return or_missing(lambda: read_table(spark, silver_root, "content", table, start, end))

    def silver(table):
        df = stored_silver(table)
        if df is None:
            raise ValueError(f"silver has daily_summary but no {table}")
        return df

    summary = stored_silver("daily_summary")
    if summary is None:
        return None
    models = {"gold_kpi_metrics": gold.kpi_metrics(summary)}
    checks = [expectations.kpi_checks(models["gold_kpi_metrics"]),
              expectations.reconcile_checks(silver("contract_stats"), summary)]
    for name in gold.CONTRACT_MODELS:
        models[name] = gold.contract_model(name, silver(name))
        checks.append(expectations.contract_checks(models[name]))
    expectations.require(*checks)
    with Publication(spark, gold_root, [*models], DATE) as tables:
        for name, model in models.items():
            tables.write(name, model)
        tables.publish(start, end)
    stored = {name: or_missing(lambda: spark.read.parquet(model_path(gold_root, name))) for name in models}
    for name, df in stored.items():
        if df is not None:
            publish_view(df.select(models[name].columns), name)
    return None if stored["gold_kpi_metrics"] is None else spark.table("gold_kpi_metrics")


def run_contract_model(spark: SparkSession, name: str, silver_root: str, gold_root: str,
                       target_date=None) -> DataFrame:
    """Incremental build of one per-contract model."""
    path = model_path(gold_root, name)
    materialize_incremental(spark, name, read_table(spark, silver_root, "content", name), path, target_date)
    return spark.read.parquet(path)
