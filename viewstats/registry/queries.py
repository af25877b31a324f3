"""Spark form of every registered query: (spark, sf_dir) -> DataFrame."""

from pyspark.sql import functions as F

from viewstats.functions import keyword_category
from viewstats.operators import content, dashboards, expectations, gold, intervals, quality, search
from viewstats.plans import catalog, gold as gold_plan, intervals as interval_plan, landing, silver
from viewstats.registry import adapters
from viewstats.registry.scratch import scratch_path
from viewstats.schemas import BRONZE_CONTENT, LOAD_DATE
from viewstats.sources.layers import read_day, read_table
from viewstats.sources.paths import table_path
from viewstats.sources.raw import read_content, read_search
from viewstats.sources.sinks import (
    clear_days, write_bronze, write_days, write_search_trending, write_silver)

DAY = "2024-01-15"
SPLIT_DAY = "2024-01-11"
LATE_DAY = "2024-02-10"


# --- frames the queries share ---------------------------------------------------------------

def _enriched(spark, sf):
    return content.enrich(adapters.bronze_content(spark, sf))


def _stats(spark, sf):
    return content.contract_stats(_enriched(spark, sf))


def _summary(spark, sf):
    return content.daily_summary(
        _stats(spark, sf), content.platform_devices(adapters.bronze_content(spark, sf)))


def _types(spark, sf):
    return content.contract_type(_stats(spark, sf))


def _segments(spark, sf):
    return content.clinginess_as_of(_types(spark, sf))


def _trending(spark, sf):
    return search.trending(adapters.bronze_search(spark, sf))


def _kpis(spark, sf):
    return gold.kpi_metrics(_summary(spark, sf))


def _stored_bronze(spark, sf):
    """A bronze layer holding the valid sessions; returns its root."""
    root = scratch_path(spark, "bronze")
    write_days(adapters.bronze_content(spark, sf), table_path(root, "content"))
    return root


def _add_late_day(spark, sf, bronze_root):
    """One more bronze day, a copy of DAY."""
    rows = adapters.bronze_content(spark, sf).where(F.col(LOAD_DATE) == DAY)
    write_days(rows.withColumn(LOAD_DATE, F.lit(LATE_DAY)), table_path(bronze_root, "content"))


# --- scans ----------------------------------------------------------------------------------

def raw_content_scan(spark, sf):
    root = scratch_path(spark, "raw")
    write_days(adapters.content_lines(spark, sf), table_path(root, "content"), file_format="text")
    return read_content(spark, root)


def raw_search_scan(spark, sf):
    root = scratch_path(spark, "raw")
    write_days(adapters.searches(spark, sf), table_path(root, "search"))
    return read_search(spark, root)


def bronze_partition_read(spark, sf):
    return read_day(spark, _stored_bronze(spark, sf), "content", DAY, schema=BRONZE_CONTENT)


def bronze_all_read(spark, sf):
    return read_table(spark, _stored_bronze(spark, sf), "content", schema=BRONZE_CONTENT)


def bronze_all_read_search(spark, sf):
    """Search bronze of two runs whose files have different extra columns."""
    root = scratch_path(spark, "bronze")
    for month, extra in (("2022-06", "device"), ("2022-07", "region")):
        rows = search.in_month(adapters.bronze_search(spark, sf), month)
        write_days(rows.withColumn(extra, F.length("keyword")), table_path(root, "search"))
    return read_table(spark, root, "search")


def land_raw_search_days(spark, sf):
    """Drop one folder of Parquet files per day, land them, count the rows of each landed day."""
    drop, root = scratch_path(spark, "drop"), scratch_path(spark, "raw")
    rows = adapters.searches(spark, sf).withColumn(
        "day", F.regexp_replace(LOAD_DATE, "-", "")).drop(LOAD_DATE)
    write_days(rows, drop, "day")
    landing.land(spark, drop, root, "search")
    return read_search(spark, root).groupBy(LOAD_DATE).agg(
        F.count("*").alias("n"), F.count("keyword").alias("with_keyword"))


def land_raw_days(spark, sf):
    """Drop one folder of JSON lines per day, land them, count the lines of each landed day."""
    drop, root = scratch_path(spark, "drop"), scratch_path(spark, "raw")
    lines = adapters.content_lines(spark, sf).withColumn(
        "day", F.regexp_replace(LOAD_DATE, "-", "")).drop(LOAD_DATE)
    write_days(lines, drop, "day", file_format="text")
    landing.land(spark, drop, root, "content")
    return read_content(spark, root).groupBy(LOAD_DATE).agg(
        F.count("*").alias("n"), F.count("_id").alias("with_id"))


def land_new_days(spark, sf):
    """Land a drop that lacks the days from one day on, then the whole drop: only those days are read."""
    drop, root = scratch_path(spark, "drop"), scratch_path(spark, "raw")
    lines = adapters.content_lines(spark, sf).withColumn("day", F.regexp_replace(LOAD_DATE, "-", ""))
    late = F.col(LOAD_DATE) >= SPLIT_DAY
    for part in (lines.where(~late), lines.where(late)):
        write_days(part.drop(LOAD_DATE), drop, "day", file_format="text")
        landing.land_new(spark, drop, root, "content")
    return read_content(spark, root).groupBy(LOAD_DATE).agg(
        F.count("*").alias("n"), F.count("_id").alias("with_id"))


# --- sinks ----------------------------------------------------------------------------------

def write_bronze_roundtrip(spark, sf):
    """Both bronze sinks written twice: the second run replaces the first."""
    root = scratch_path(spark, "bronze")
    valid, invalid = quality.split(adapters.sessions(spark, sf), quality.content_rules())
    for _ in range(2):
        write_bronze(valid, invalid, root, "content")
    stored = read_table(spark, root, "content", schema=BRONZE_CONTENT)
    rejected = read_table(spark, root, "content_quarantine", schema=BRONZE_CONTENT)
    return (stored.withColumn("layer", F.lit("valid"))
            .unionByName(rejected.withColumn("layer", F.lit("quarantine"))))


def write_silver_roundtrip(spark, sf):
    """The silver job run twice over all days, the first time with a day that bronze then loses; one
    row per contract and day from what it stored."""
    bronze_root, root = _stored_bronze(spark, sf), scratch_path(spark, "silver")
    _add_late_day(spark, sf, bronze_root)
    silver.run_content(spark, bronze_root, root)
    clear_days(spark, table_path(bronze_root, "content"), [LATE_DAY])
    silver.run_content(spark, bronze_root, root)
    return _silver_rows(spark, root)


def silver_failed_run(spark, sf):
    """What the first of two silver runs stored, after the second, over one more day, failed with most of
    its tables written; one row per contract and day."""
    bronze_root, root = _stored_bronze(spark, sf), scratch_path(spark, "silver")
    silver.run_content(spark, bronze_root, root)
    _add_late_day(spark, sf, bronze_root)
    try:
        silver.run_content(spark, bronze_root, root, mode="no such mode")
    except ValueError:
        return _silver_rows(spark, root)
    raise RuntimeError("the second run was to fail")


def _silver_rows(spark, root):
    table = lambda name: read_table(spark, root, "content", name)
    watched = table("contract_most_watch").groupBy(*content.KEYS).agg(
        F.count("*").alias("most_watch_rows"))
    return (table("contract_stats").join(table("contract_type"), content.KEYS)
            .join(table("contract_taste"), content.KEYS).join(watched, content.KEYS)
            .join(table("contract_activeness"), content.KEYS)
            .join(table("contract_clinginess").select(*content.KEYS, "clinginess"), content.KEYS)
            .join(table("daily_summary").select(LOAD_DATE, "active_contracts"), LOAD_DATE))


def write_search_roundtrip(spark, sf):
    root = scratch_path(spark, "silver")
    for _ in range(2):
        write_search_trending(_trending(spark, sf), root)
    return read_table(spark, root, "search", "search_trending")


def gold_view(spark, sf):
    gold_plan.publish_view(_kpis(spark, sf), "gold_kpi_metrics")
    return spark.sql("SELECT date, active_contracts, unique_devices FROM gold_kpi_metrics")


def gold_catalog_views(spark, sf):
    """Rows per model and day of the gold models, by another session through the views of the catalog."""
    bronze_root, root, stored = _stored_bronze(spark, sf), scratch_path(spark, "silver"), scratch_path(spark, "gold")
    silver.run_content(spark, bronze_root, root)
    write_search_trending(_trending(spark, sf), root)
    for data_type in ("content", "search"):
        gold_plan.run(spark, root, stored, data_type)
    database = f"gold_{stored.rsplit('-', 1)[1]}"
    models = catalog.publish(spark, stored, database)
    other = spark.newSession()
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS model, {'CAST(NULL AS DATE)' if name == 'gold_search_trending' else 'date'} AS date, "
        f"count(*) AS n FROM {database}.{name} GROUP BY ALL" for name in models)
    return other.sql(counts)


def gold_incremental_roundtrip(spark, sf):
    """A full first build, then two builds of one day: still one copy of every row."""
    root = scratch_path(spark, "gold")
    tastes = content.taste(_stats(spark, sf))
    for target in (None, DAY, DAY):
        gold_plan.materialize_incremental(spark, "contract_taste", tastes, root, target)
    return spark.read.parquet(root).select("contract", "date", "taste")


# --- data quality ---------------------------------------------------------------------------

def dedup_by_id(spark, sf):
    return quality.dedup_by_id(adapters.session_copies(spark, sf))


def dq_valid_content(spark, sf):
    return adapters.bronze_content(spark, sf)


def dq_quarantine_content(spark, sf):
    return quality.split(adapters.sessions(spark, sf), quality.content_rules())[1]


def dq_report_content(spark, sf):
    return quality.report_for(adapters.sessions(spark, sf), "content")


def dq_valid_search(spark, sf):
    return adapters.bronze_search(spark, sf)


def dq_quarantine_search(spark, sf):
    return quality.split(adapters.searches(spark, sf), quality.search_rules())[1]


def dq_report_search(spark, sf):
    return quality.report_for(adapters.searches(spark, sf), "search")


def dq_rule_profile(spark, sf):
    return quality.rule_profile(adapters.sessions(spark, sf), quality.content_rules())


def dq_null_profile(spark, sf):
    return quality.null_profile(
        adapters.sessions(spark, sf), ["contract", "mac", "total_duration"])


# --- content --------------------------------------------------------------------------------

def content_enrich(spark, sf):
    return _enriched(spark, sf)


def duration_by_category(spark, sf):
    return content.duration_by_category(_enriched(spark, sf))


def devices_per_contract(spark, sf):
    return content.devices_per_contract(_enriched(spark, sf))


def platform_devices(spark, sf):
    return content.platform_devices(adapters.bronze_content(spark, sf))


def contract_stats(spark, sf):
    return _stats(spark, sf)


def unpivot_categories(spark, sf):
    return content.unpivot_categories(_stats(spark, sf))


def daily_summary(spark, sf):
    return _summary(spark, sf)


def most_watch(spark, sf):
    return content.most_watch(_stats(spark, sf))


def taste(spark, sf):
    return content.taste(_stats(spark, sf))


def type_quantiles(spark, sf):
    return content.usage_quartiles(content.viewing_totals(_stats(spark, sf)))


def contract_type(spark, sf):
    return _types(spark, sf)


def activeness_snapshot(spark, sf):
    return content.activeness_snapshot(_stats(spark, sf))


def activeness_as_of(spark, sf):
    return content.activeness(_stats(spark, sf), "as_of")


def activeness_prior(spark, sf):
    return content.activeness(_stats(spark, sf), "prior")


def activeness_carried(spark, sf):
    return content.activeness_carried(
        _stats(spark, sf), days=adapters.bronze_content(spark, sf))


def _plain_intervals(rows):
    return rows.select("contract", "activeness", F.col("valid_from").cast("string").alias("valid_from"),
                       F.col("valid_to").cast("string").alias("valid_to"))


def activeness_intervals(spark, sf):
    return _plain_intervals(intervals.activeness_intervals(_stats(spark, sf)))


def activeness_intervals_stored(spark, sf):
    """Intervals of all days, then made again from one day on out of what was stored."""
    root = scratch_path(spark, "silver")
    write_days(_stats(spark, sf), table_path(root, "content", "contract_stats"))
    interval_plan.run(spark, root)
    interval_plan.run(spark, root, SPLIT_DAY)
    return _plain_intervals(interval_plan.read_intervals(spark, root))


def activeness_expanded(spark, sf):
    """The rows of ``activeness_carried`` out of intervals."""
    return intervals.expanded(intervals.activeness_intervals(_stats(spark, sf)),
                              adapters.bronze_content(spark, sf))


def clinginess(spark, sf):
    stats = _stats(spark, sf)
    return content.clinginess(content.contract_type(stats), content.activeness(stats, "as_of"))


def clinginess_as_of(spark, sf):
    return _segments(spark, sf)


def clinginess_snapshot(spark, sf):
    stats = _stats(spark, sf)
    return content.clinginess(content.contract_type(stats), content.activeness(stats, "snapshot"))


# --- search ---------------------------------------------------------------------------------

def search_month_filter(spark, sf):
    return search.in_month(adapters.searches(spark, sf), "2022-06")


def search_keyword_counts(spark, sf):
    return search.keyword_counts(adapters.searches(spark, sf))


def top_keyword_june(spark, sf):
    return search.top_keyword(search.in_month(adapters.bronze_search(spark, sf), "2022-06"), "june")


def top_keyword_july(spark, sf):
    return search.top_keyword(search.in_month(adapters.bronze_search(spark, sf), "2022-07"), "july")


def category_map(spark, sf):
    """Searches per keyword (NULL too), each keyword classified once."""
    return (adapters.searches(spark, sf).groupBy("keyword").agg(F.count("*").alias("n"))
            .withColumn("category", keyword_category(F.col("keyword"))))


def search_trending(spark, sf):
    return _trending(spark, sf)


# --- gold -----------------------------------------------------------------------------------

def gold_kpi_metrics(spark, sf):
    return _kpis(spark, sf)


def gold_contract_activeness(spark, sf):
    return gold.contract_model("contract_activeness", activeness_carried(spark, sf))


def gold_contract_clinginess(spark, sf):
    return gold.contract_model("contract_clinginess", _segments(spark, sf))


def gold_contract_most_watch(spark, sf):
    return gold.contract_model("contract_most_watch", most_watch(spark, sf))


def gold_contract_taste(spark, sf):
    return gold.contract_model("contract_taste", taste(spark, sf))


def gold_contract_type(spark, sf):
    return gold.contract_model("contract_type", _types(spark, sf))


def gold_contract_taste_day(spark, sf):
    return gold.contract_model("contract_taste", taste(spark, sf), DAY)


def gold_search_trending(spark, sf):
    return gold.search_trending(_trending(spark, sf))


# --- checks ---------------------------------------------------------------------------------

def expect_not_null(spark, sf):
    """The declared not-null columns of all seven gold models over stored silver, and those of the raw
    sessions, which do have NULLs; failures per column."""
    bronze_root, root = _stored_bronze(spark, sf), scratch_path(spark, "silver")
    write_days(adapters.bronze_search(spark, sf), table_path(bronze_root, "search"))
    silver.run_content(spark, bronze_root, root)
    silver.run_search(spark, bronze_root, root)
    table = lambda name, kind="content": read_table(spark, root, kind, name)
    models = {
        "sessions": expectations.not_null(
            adapters.sessions(spark, sf), ["_id", "contract", "mac", "total_duration", "app_name"]),
        "gold_kpi_metrics": expectations.not_null(
            gold.kpi_metrics(table("daily_summary")), gold.KPI_COLUMNS),
        "search_trending": expectations.not_null(
            gold.search_trending(table("search_trending", "search")), gold.TRENDING_COLUMNS),
    }
    for name in gold.CONTRACT_MODELS:
        models[name] = expectations.contract_checks(gold.contract_model(name, table(name)))
    result = None
    for name, checks in models.items():
        named = checks.withColumn("model", F.lit(name))
        result = named if result is None else result.unionByName(named)
    return result


def expect_unique_date(spark, sf):
    """Once on the KPI table, where no date repeats, and once on rows where all of them do."""
    kpis = _kpis(spark, sf)
    stats = _stats(spark, sf).withColumnRenamed(LOAD_DATE, "date")
    return (expectations.unique(kpis, "date").withColumn("model", F.lit("gold_kpi_metrics"))
            .unionByName(expectations.unique(stats, "date")
                         .withColumn("model", F.lit("contract_stats"))))


def expect_trending_values(spark, sf):
    """The declared domain, and a narrower one that the data breaks."""
    trending = gold.search_trending(_trending(spark, sf))
    declared = expectations.accepted_values(trending, "trending_type", expectations.TRENDING_VALUES)
    narrow = expectations.accepted_values(trending, "trending_type", ["Unchanged"])
    return (declared.withColumn("domain", F.lit("declared"))
            .unionByName(narrow.withColumn("domain", F.lit("narrow"))))


def check_kpi_dau(spark, sf):
    """Against a summary that has one day wrong and one day missing."""
    wrong = F.when(F.col(LOAD_DATE) == DAY, F.col("active_contracts") + 1).otherwise(
        F.col("active_contracts"))
    summary = _summary(spark, sf).withColumn("active_contracts", wrong).where(
        F.col(LOAD_DATE) != SPLIT_DAY)
    return expectations.contracts_reconcile(_stats(spark, sf), summary)


# --- backfills ------------------------------------------------------------------------------

def backfill_range(spark, sf):
    """Silver filled by two range jobs; the second one counts the history the first one stored, and a
    third run takes back a day that bronze lost."""
    bronze_root, root = _stored_bronze(spark, sf), scratch_path(spark, "silver")
    _add_late_day(spark, sf, bronze_root)
    silver.run_content(spark, bronze_root, root, end="2024-01-10")
    silver.run_content(spark, bronze_root, root, start=SPLIT_DAY)
    clear_days(spark, table_path(bronze_root, "content"), [LATE_DAY])
    silver.run_content(spark, bronze_root, root, start=LATE_DAY, end=LATE_DAY)
    segments = read_table(spark, root, "content", "contract_clinginess")
    active = read_table(spark, root, "content", "contract_activeness")
    return active.join(segments.drop("activeness"), content.KEYS, "left")


def backfill_most_watch_taste(spark, sf):
    """Both tables derived again from the second half of the stored contract_stats."""
    root = scratch_path(spark, "silver")
    write_silver({"contract_stats": _stats(spark, sf)}, root)
    silver.backfill_most_watch_taste(spark, root, start=SPLIT_DAY)
    watched = read_table(spark, root, "content", "contract_most_watch")
    return watched.join(read_table(spark, root, "content", "contract_taste"), content.KEYS)


# --- dashboards -----------------------------------------------------------------------------

def dash_kpi_cards(spark, sf):
    return dashboards.kpi_cards(_kpis(spark, sf))


def dash_type_distribution(spark, sf):
    return dashboards.type_distribution(_summary(spark, sf))


def dash_daily_trend(spark, sf):
    return dashboards.daily_trend(_summary(spark, sf))


def dash_clinginess_segments(spark, sf):
    return dashboards.clinginess_segments(_segments(spark, sf))


def dash_taste_matrix(spark, sf):
    return dashboards.taste_matrix(taste(spark, sf))


def dash_transitions(spark, sf):
    return dashboards.category_transitions(_trending(spark, sf))


def dash_changed_split(spark, sf):
    return dashboards.changed_split(_trending(spark, sf))


def dash_top_keywords(spark, sf):
    return dashboards.top_keywords(adapters.bronze_search(spark, sf))


QUERIES = {f.__name__: f for f in [
    raw_content_scan, raw_search_scan, bronze_partition_read, bronze_all_read, bronze_all_read_search,
    land_raw_days, land_raw_search_days, land_new_days,
    write_bronze_roundtrip, write_silver_roundtrip, silver_failed_run, write_search_roundtrip, gold_view,
    gold_catalog_views,
    gold_incremental_roundtrip, dedup_by_id, dq_valid_content, dq_quarantine_content,
    dq_report_content, dq_valid_search, dq_quarantine_search, dq_report_search, dq_rule_profile,
    dq_null_profile, content_enrich, duration_by_category, devices_per_contract,
    platform_devices, contract_stats, unpivot_categories, daily_summary, most_watch, taste,
    type_quantiles, contract_type, activeness_snapshot, activeness_as_of, activeness_prior,
    activeness_carried, activeness_intervals, activeness_intervals_stored, activeness_expanded,
    clinginess, clinginess_as_of, clinginess_snapshot, search_month_filter,
    search_keyword_counts, top_keyword_june, top_keyword_july, category_map, search_trending,
    gold_kpi_metrics, gold_contract_activeness, gold_contract_clinginess,
    gold_contract_most_watch, gold_contract_taste, gold_contract_type, gold_contract_taste_day,
    gold_search_trending, expect_not_null, expect_unique_date, expect_trending_values,
    check_kpi_dau, backfill_range, backfill_most_watch_taste, dash_kpi_cards,
    dash_type_distribution, dash_daily_trend, dash_clinginess_segments, dash_taste_matrix,
    dash_transitions, dash_changed_split, dash_top_keywords,
]}
