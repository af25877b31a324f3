"""DuckDB form of every registered query, over the same whole tables."""

from viewstats.registry.adapters import APPS, KEYWORDS
from viewstats.registry.queries import DAY, SPLIT_DAY
from viewstats.schemas import (
    APP_CATEGORIES, CATEGORY_LABELS, KEYWORD_CATEGORIES, OTHER_CATEGORY, STATS_CATEGORIES,
    SUMMARY_CATEGORIES, UNMATCHED_KEYWORD)


def _text(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _category_case(keyword: str) -> str:
    branches = []
    for category, patterns in KEYWORD_CATEGORIES:
        tests = " OR ".join(f"contains(lower({keyword}), {_text(p)})" for p in patterns)
        branches.append(f"WHEN {tests} THEN {_text(category)}")
    return f"CASE {' '.join(branches)} ELSE {_text(UNMATCHED_KEYWORD)} END"


_TYPE_CASE = "CASE " + " ".join(
    f"WHEN app_name IN {_in(codes)} THEN {_text(category)}"
    for category, codes in APP_CATEGORIES.items()) + f" ELSE {_text(OTHER_CATEGORY)} END"
_SUMS = ", ".join(
    f'CAST(coalesce(sum(total_duration) FILTER (type = {_text(c)}), 0) AS BIGINT) AS "{c}"'
    for c in STATS_CATEGORIES)
_SUMMARY_SUMS = ", ".join(f'CAST(sum("{c}") AS BIGINT) AS "{c}"' for c in SUMMARY_CATEGORIES)
_WATCHED = " + ".join(f'"{c}"' for c in SUMMARY_CATEGORIES)
_EVERYTHING = " + ".join(f'"{c}"' for c in STATS_CATEGORIES)
_UNPIVOT = " UNION ALL ".join(
    f"""SELECT contract, _load_date, {_text(label)} AS category, "{c}" AS total_duration FROM stats"""
    for c, label in CATEGORY_LABELS.items())
_TASTE = "concat_ws('-', " + ", ".join(
    f"""CASE WHEN "{c}" > 0 THEN {_text(label)} END""" for c, label in CATEGORY_LABELS.items()) + ")"
_CLINGINESS = """CASE
    WHEN type = 'Low' AND activeness <= 20 THEN 'Low'
    WHEN type = 'Low' THEN 'Medium'
    WHEN type = 'Medium' AND activeness <= 10 THEN 'Low'
    WHEN type = 'Medium' AND activeness <= 20 THEN 'Medium'
    WHEN type = 'Medium' THEN 'High'
    WHEN type = 'High' AND activeness <= 10 THEN 'Medium'
    ELSE 'High' END"""

_K = "CAST(json_extract_string(props, '$.k') AS INT)"

def _content() -> str:
    """sessions -> bronze -> enriched -> stats -> devices -> summary -> types, as CTEs."""
    return f"""
    sessions AS (
        SELECT CAST(event_id AS VARCHAR) AS _id,
               CASE WHEN k = 98 THEN NULL ELSE 'C' || CAST(user_id AS VARCHAR) END AS contract,
               CASE WHEN k = 97 THEN NULL
                    ELSE 'M' || CAST(user_id * 2 + k % 3 AS VARCHAR) END AS mac,
               CASE WHEN k = 96 THEN NULL
                    WHEN k = 99 THEN -1 - CAST(floor(value) AS BIGINT)
                    ELSE CAST(floor(value) AS BIGINT) END AS total_duration,
               {_list(APPS)}[k % 16 + 1] AS app_name,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS _load_date
        FROM (SELECT *, {_K} AS k FROM events)),
    tagged AS (
        SELECT *, coalesce(contract IS NOT NULL AND mac IS NOT NULL
                           AND total_duration IS NOT NULL AND total_duration >= 0, FALSE) AS ok
        FROM sessions),
    bronze AS (SELECT * EXCLUDE (ok) FROM tagged WHERE ok),
    enriched AS (SELECT *, {_TYPE_CASE} AS type FROM bronze),
    stats AS (
        SELECT contract, {_SUMS}, count(DISTINCT mac) AS total_devices, _load_date
        FROM enriched GROUP BY contract, _load_date),
    devices AS (
        SELECT _load_date, count(DISTINCT mac) AS unique_devices FROM bronze GROUP BY _load_date),
    totals AS (
        SELECT _load_date, {_SUMMARY_SUMS}, count(DISTINCT contract) AS active_contracts
        FROM stats GROUP BY _load_date),
    summary AS (
        SELECT t.*, unique_devices, {_WATCHED} AS total_duration,
               ({_WATCHED}) / active_contracts AS avg_session_duration
        FROM totals t LEFT JOIN devices USING (_load_date)),
    viewing AS (SELECT contract, _load_date, {_EVERYTHING} AS total_duration FROM stats),
    quartiles AS (
        SELECT _load_date, quantile_disc(total_duration, 0.25) AS q1,
               quantile_disc(total_duration, 0.75) AS q3
        FROM viewing GROUP BY _load_date),
    types AS (
        SELECT contract, _load_date, total_duration,
               CASE WHEN total_duration < q1 THEN 'Low' WHEN total_duration > q3 THEN 'High'
                    ELSE 'Medium' END AS type
        FROM viewing JOIN quartiles USING (_load_date)),
    tastes AS (SELECT contract, {_TASTE} AS taste, _load_date FROM stats),
    unpivoted AS ({_UNPIVOT}),
    watched AS (
        SELECT contract, category AS most_watch, _load_date
        FROM (SELECT *, rank() OVER (PARTITION BY contract, _load_date
                                     ORDER BY total_duration DESC) AS r FROM unpivoted)
        WHERE r = 1),
    active AS (
        SELECT contract, _load_date,
               count(*) OVER (PARTITION BY contract ORDER BY _load_date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS activeness
        FROM stats),
    carried AS (
        SELECT s.contract, count(*) AS activeness, d._load_date
        FROM (SELECT DISTINCT _load_date FROM stats) d
        JOIN stats s ON s._load_date <= d._load_date GROUP BY s.contract, d._load_date),
    segments AS (
        SELECT contract, _load_date, type, activeness, {_CLINGINESS} AS clinginess
        FROM types JOIN active USING (contract, _load_date)),
    kpis AS (
        SELECT CAST(_load_date AS DATE) AS date,
               CAST(sum({_WATCHED}) AS BIGINT) AS total_duration,
               max(active_contracts) AS active_contracts,
               max(coalesce(unique_devices, 0)) AS unique_devices,
               CASE WHEN max(active_contracts) = 0 THEN 0.0
                    ELSE CAST(sum({_WATCHED}) AS DOUBLE) / max(active_contracts) END
                   AS avg_session_duration
        FROM summary GROUP BY _load_date)"""


_SEARCH = f"""
    searches AS (
        SELECT user_id, {_list(KEYWORDS)}[k % 17 + 1] AS keyword,
               CAST(CAST(DATE '2022-06-01' + 2 * (CAST(day(ts) AS INT) - 1) AS DATE) AS VARCHAR)
                   AS _load_date
        FROM (SELECT *, {_K} AS k FROM events)),
    found AS (SELECT * FROM searches WHERE user_id IS NOT NULL AND keyword IS NOT NULL),
    counts AS (
        SELECT substr(_load_date, 1, 7) AS month, user_id, keyword, count(*) AS times
        FROM found GROUP BY ALL),
    tops AS (
        SELECT month, user_id, keyword
        FROM (SELECT *, rank() OVER (PARTITION BY month, user_id ORDER BY times DESC) AS r
              FROM counts)
        WHERE r = 1),
    classified AS (SELECT *, {_category_case('keyword')} AS category FROM tops),
    paired AS (
        SELECT j.user_id, j.keyword AS most_search_june, l.keyword AS most_search_july,
               j.category AS category_june, l.category AS category_july
        FROM classified j JOIN classified l
          ON j.user_id = l.user_id AND j.month = '2022-06' AND l.month = '2022-07'),
    trending AS (
        SELECT *, CASE WHEN category_june = category_july THEN 'Unchanged' ELSE 'Changed' END
                   AS trending_type,
               CASE WHEN category_june = category_july THEN 'Unchanged'
                    ELSE category_june || '; ' || category_july END AS previous
        FROM paired),
    gold_trending AS (
        SELECT left(CAST(user_id AS VARCHAR), 50) AS user_id, most_search_june, category_june,
               most_search_july, category_july, trending_type, previous
        FROM trending)"""


def _on_content(select: str) -> str:
    return f"WITH {_content()} {select}"


def _on_search(select: str) -> str:
    return f"WITH {_SEARCH} {select}"


def _report(relation: str, ok: str, limit: float) -> str:
    return f"""SELECT _load_date, count(*) AS total, count(*) FILTER ({ok}) AS valid,
        count(*) FILTER (NOT ({ok})) AS invalid,
        count(*) FILTER (NOT ({ok})) / count(*) AS rate,
        count(*) FILTER (NOT ({ok})) / count(*) > {limit} AS exceeded
        FROM {relation} GROUP BY _load_date"""


def _rule_profile() -> str:
    rules = {"not_null_contract": "contract IS NOT NULL", "not_null_mac": "mac IS NOT NULL",
             "not_null_total_duration": "total_duration IS NOT NULL",
             "non_negative_total_duration": "total_duration >= 0"}
    return " UNION ALL ".join(
        f"""SELECT _load_date, count(*) AS total, {_text(name)} AS rule,
            count(*) FILTER ({test}) AS passed,
            count(*) FILTER ({test}) / count(*) * 100 AS pass_pct
            FROM sessions GROUP BY _load_date""" for name, test in rules.items())


def _null_profile() -> str:
    return " UNION ALL ".join(
        f"""SELECT _load_date, count(*) AS total, {_text(c)} AS column_name,
            count(*) FILTER ({c} IS NULL) AS null_count FROM sessions GROUP BY _load_date"""
        for c in ("contract", "mac", "total_duration"))


def _gold_contract(relation: str, columns: str) -> str:
    return f"SELECT contract, CAST(_load_date AS DATE) AS date, {columns} FROM {relation}"


def _expect_not_null() -> str:
    models = {
        "sessions": ("sessions", ["_id", "contract", "mac", "total_duration", "app_name"]),
        "gold_kpi_metrics": ("kpis", ["date", "total_duration", "active_contracts",
                                      "unique_devices", "avg_session_duration"]),
        "contract_most_watch": ("watched", ["contract", "_load_date"]),
        "contract_taste": ("tastes", ["contract", "_load_date"]),
        "contract_type": ("types", ["contract", "_load_date"]),
        "search_trending": ("gold_trending", [
            "user_id", "most_search_june", "category_june", "most_search_july", "category_july",
            "trending_type", "previous"]),
        "contract_activeness": ("carried", ["contract", "_load_date"]),
        "contract_clinginess": ("segments", ["contract", "_load_date"]),
    }
    return " UNION ALL ".join(
        f"""SELECT 'not_null' AS "check",
            {_text('date' if c == '_load_date' else c)} AS column_name,
            count(*) FILTER ({c} IS NULL) AS failures, {_text(model)} AS model FROM {relation}"""
        for model, (relation, columns) in models.items() for c in columns)


def _distribution() -> str:
    whole = " + ".join(f'"{c}"' for c in SUMMARY_CATEGORIES)
    return " UNION ALL ".join(
        f"""SELECT {_text(CATEGORY_LABELS[c])} AS content_type,
            CAST(sum("{c}") AS BIGINT) AS total_duration,
            CAST(sum("{c}") AS BIGINT) / CAST(sum({whole}) AS BIGINT) AS share FROM summary"""
        for c in SUMMARY_CATEGORIES)


_INTERVALS = """
        SELECT contract, activeness, _load_date AS valid_from,
               CAST(CAST(lead(_load_date) OVER (PARTITION BY contract ORDER BY _load_date) AS DATE) - 1
                    AS VARCHAR) AS valid_to
        FROM active"""
_SEGMENT_COLUMNS = "contract, _load_date, type, activeness, clinginess"

_SILVER_ROWS = """
        SELECT stats.*, total_duration, type, taste, most_watch_rows, activeness, clinginess,
               active_contracts
        FROM stats JOIN tastes USING (contract, _load_date)
        JOIN segments USING (contract, _load_date)
        JOIN (SELECT contract, _load_date, total_duration FROM types) USING (contract, _load_date)
        JOIN (SELECT contract, _load_date, count(*) AS most_watch_rows FROM watched GROUP BY ALL)
            USING (contract, _load_date)
        JOIN (SELECT _load_date, active_contracts FROM summary) USING (_load_date)"""


def _catalog_counts() -> str:
    models = {"gold_kpi_metrics": "kpis", "contract_most_watch": "watched", "contract_taste": "tastes",
              "contract_type": "types", "contract_activeness": "carried", "contract_clinginess": "segments"}
    return " UNION ALL ".join([
        f"""SELECT {_text(model)} AS model, CAST({'date' if relation == 'kpis' else '_load_date'} AS DATE) AS date,
            count(*) AS n FROM {relation} GROUP BY ALL""" for model, relation in models.items()] + [
        "SELECT 'gold_search_trending' AS model, CAST(NULL AS DATE) AS date, count(*) AS n FROM gold_trending"])


ORACLE = {
    "raw_content_scan": _on_content("SELECT * FROM sessions"),
    "raw_search_scan": _on_search("SELECT * FROM searches"),
    "bronze_partition_read": _on_content(f"SELECT * FROM bronze WHERE _load_date = '{DAY}'"),
    "bronze_all_read": _on_content("SELECT * FROM bronze"),
    "bronze_all_read_search": _on_search("""
        SELECT *, CASE WHEN substr(_load_date, 1, 7) = '2022-06' THEN CAST(length(keyword) AS INT) END
                   AS device,
               CASE WHEN substr(_load_date, 1, 7) = '2022-07' THEN CAST(length(keyword) AS INT) END
                   AS region
        FROM found"""),
    "land_raw_search_days": _on_search("""
        SELECT _load_date, count(*) AS n, count(keyword) AS with_keyword
        FROM searches GROUP BY _load_date"""),
    "land_raw_days": _on_content(
        "SELECT _load_date, count(*) AS n, count(_id) AS with_id FROM sessions GROUP BY _load_date"),
    "land_new_days": _on_content(
        "SELECT _load_date, count(*) AS n, count(_id) AS with_id FROM sessions GROUP BY _load_date"),
    "write_bronze_roundtrip": _on_content(
        "SELECT * EXCLUDE (ok), CASE WHEN ok THEN 'valid' ELSE 'quarantine' END AS layer FROM tagged"),
    "write_silver_roundtrip": _on_content(_SILVER_ROWS),
    "silver_failed_run": _on_content(_SILVER_ROWS),
    "write_search_roundtrip": _on_search("SELECT * FROM trending"),
    "gold_view": _on_content("SELECT date, active_contracts, unique_devices FROM kpis"),
    "gold_catalog_views": f"WITH {_content()}, {_SEARCH} {_catalog_counts()}",
    "gold_incremental_roundtrip": _on_content(_gold_contract("tastes", "taste")),
    "dedup_by_id": _on_content("""
        SELECT * REPLACE (CASE WHEN total_duration % 2 = 0 THEN total_duration + 1
                               ELSE total_duration END AS total_duration) FROM sessions
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, _load_date FROM sessions
        WHERE CAST(_id AS BIGINT) % 10 = 0"""),
    "dq_valid_content": _on_content("SELECT * FROM bronze"),
    "dq_quarantine_content": _on_content("SELECT * EXCLUDE (ok) FROM tagged WHERE NOT ok"),
    "dq_report_content": _on_content(_report("tagged", "ok", 0.05)),
    "dq_valid_search": _on_search("SELECT * FROM found"),
    "dq_quarantine_search": _on_search(
        "SELECT * FROM searches WHERE user_id IS NULL OR keyword IS NULL"),
    "dq_report_search": _on_search(
        _report("searches", "user_id IS NOT NULL AND keyword IS NOT NULL", 0.4)),
    "dq_rule_profile": _on_content(_rule_profile()),
    "dq_null_profile": _on_content(_null_profile()),
    "content_enrich": _on_content("SELECT * FROM enriched"),
    "duration_by_category": _on_content("""
        SELECT contract, _load_date, type, CAST(sum(total_duration) AS BIGINT) AS duration_by_category
        FROM enriched GROUP BY contract, _load_date, type"""),
    "devices_per_contract": _on_content("SELECT contract, _load_date, total_devices FROM stats"),
    "platform_devices": _on_content("SELECT * FROM devices"),
    "contract_stats": _on_content("SELECT * FROM stats"),
    "unpivot_categories": _on_content("SELECT * FROM unpivoted"),
    "daily_summary": _on_content("SELECT * FROM summary"),
    "most_watch": _on_content("SELECT * FROM watched"),
    "taste": _on_content("SELECT * FROM tastes"),
    "type_quantiles": _on_content("SELECT * FROM quartiles"),
    "contract_type": _on_content("SELECT * FROM types"),
    "activeness_snapshot": _on_content("""
        SELECT contract, count(DISTINCT _load_date) AS activeness,
               (SELECT max(_load_date) FROM stats) AS _load_date
        FROM stats GROUP BY contract"""),
    "activeness_as_of": _on_content("SELECT * FROM active"),
    "activeness_prior": _on_content("""
        SELECT contract, activeness - 1 AS activeness, _load_date
        FROM active WHERE activeness > 1"""),
    "activeness_carried": _on_content("SELECT * FROM carried"),
    "activeness_intervals": _on_content(_INTERVALS),
    "activeness_intervals_stored": _on_content(_INTERVALS),
    "activeness_expanded": _on_content("SELECT * FROM carried"),
    "clinginess": _on_content(f"SELECT {_SEGMENT_COLUMNS} FROM segments"),
    "clinginess_as_of": _on_content(f"SELECT {_SEGMENT_COLUMNS} FROM segments"),
    "clinginess_snapshot": _on_content(f"""
        SELECT contract, _load_date, type, activeness, {_CLINGINESS} AS clinginess
        FROM types JOIN (SELECT contract, count(*) AS activeness FROM stats GROUP BY contract)
            USING (contract)"""),
    "search_month_filter": _on_search("SELECT * FROM searches WHERE substr(_load_date, 1, 7) = '2022-06'"),
    "search_keyword_counts": _on_search(
        "SELECT user_id, keyword, count(*) AS times FROM found GROUP BY user_id, keyword"),
    "top_keyword_june": _on_search(
        "SELECT user_id, keyword AS most_search_june FROM tops WHERE month = '2022-06'"),
    "top_keyword_july": _on_search(
        "SELECT user_id, keyword AS most_search_july FROM tops WHERE month = '2022-07'"),
    "category_map": _on_search(f"""
        SELECT keyword, {_category_case('keyword')} AS category, count(*) AS n
        FROM searches GROUP BY ALL"""),
    "search_trending": _on_search("SELECT * FROM trending"),
    "gold_kpi_metrics": _on_content("SELECT * FROM kpis"),
    "gold_contract_activeness": _on_content(_gold_contract("carried", "activeness")),
    "gold_contract_clinginess": _on_content(
        _gold_contract("segments", "type, activeness, clinginess")),
    "gold_contract_most_watch": _on_content(_gold_contract("watched", "most_watch")),
    "gold_contract_taste": _on_content(_gold_contract("tastes", "taste")),
    "gold_contract_type": _on_content(_gold_contract("types", "total_duration, type")),
    "gold_contract_taste_day": _on_content(
        _gold_contract("tastes", "taste") + f" WHERE _load_date = '{DAY}'"),
    "gold_search_trending": _on_search("SELECT * FROM gold_trending"),
    "expect_not_null": f"WITH {_content()}, {_SEARCH} {_expect_not_null()}",
    "expect_unique_date": _on_content("""
        SELECT 'unique' AS "check", 'date' AS column_name, count(*) AS failures,
               'gold_kpi_metrics' AS model
        FROM (SELECT date FROM kpis GROUP BY date HAVING count(*) > 1)
        UNION ALL
        SELECT 'unique', 'date', count(*), 'contract_stats'
        FROM (SELECT _load_date FROM stats GROUP BY _load_date HAVING count(*) > 1)"""),
    "expect_trending_values": _on_search("""
        SELECT 'accepted_values' AS "check", 'trending_type' AS column_name,
               count(*) FILTER (trending_type NOT IN ('Changed', 'Unchanged')) AS failures,
               'declared' AS domain FROM gold_trending
        UNION ALL
        SELECT 'accepted_values', 'trending_type',
               count(*) FILTER (trending_type NOT IN ('Unchanged')), 'narrow' FROM gold_trending"""),
    "check_kpi_dau": _on_content(f"""
        SELECT _load_date, total_dau, active_contracts,
               CAST(coalesce(total_dau = active_contracts, FALSE) AS INT) AS matches
        FROM (SELECT _load_date, count(DISTINCT trim(contract)) AS total_dau FROM stats
              WHERE contract IS NOT NULL GROUP BY _load_date)
        FULL JOIN (SELECT _load_date, active_contracts
                          + CASE WHEN _load_date = '{DAY}' THEN 1 ELSE 0 END AS active_contracts
                   FROM summary WHERE _load_date <> '{SPLIT_DAY}') USING (_load_date)"""),
    "backfill_range": _on_content("""
        SELECT contract, _load_date, carried.activeness, type, clinginess
        FROM carried LEFT JOIN segments USING (contract, _load_date)"""),
    "backfill_most_watch_taste": _on_content(f"""
        SELECT contract, _load_date, most_watch, taste
        FROM watched JOIN tastes USING (contract, _load_date)
        WHERE _load_date >= '{SPLIT_DAY}'"""),
    "dash_kpi_cards": _on_content(
        "SELECT *, total_duration / 3600 AS total_viewing_hours FROM kpis"),
    "dash_type_distribution": _on_content(_distribution()),
    "dash_daily_trend": _on_content(
        "SELECT CAST(_load_date AS DATE) AS date, total_duration FROM summary"),
    "dash_clinginess_segments": _on_content(
        "SELECT _load_date, clinginess, count(*) AS contracts FROM segments GROUP BY ALL"),
    "dash_taste_matrix": _on_content(
        "SELECT _load_date, taste, count(*) AS contracts FROM tastes GROUP BY ALL"),
    "dash_transitions": _on_search(
        "SELECT category_june, category_july, count(*) AS n FROM trending GROUP BY ALL"),
    "dash_changed_split": _on_search(
        "SELECT trending_type, count(DISTINCT user_id) AS users FROM trending GROUP BY ALL"),
    "dash_top_keywords": _on_search("""
        SELECT month, keyword, times, rank
        FROM (SELECT *, rank() OVER (PARTITION BY month ORDER BY times DESC) AS rank
              FROM (SELECT substr(_load_date, 1, 7) AS month, keyword, count(*) AS times
                    FROM found GROUP BY ALL))
        WHERE rank <= 10"""),
}
