"""The SQL each registered query is checked against, over the same tables.

Written apart from the DataFrame code: joins, windows and self-joins in their
plain textbook form, with no regard to scale.
"""

# --- stand-in inputs ----------------------------------------------------------

CELL = """
cell AS (
  SELECT p_brand, CAST(date_trunc('month', l_shipdate) AS date) AS m,
         sum(CAST(l_extendedprice AS decimal(18,2))) AS s, CAST(count(*) AS bigint) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""

DIM = """
dim AS (
  SELECT md5(concat('BLS|', p_brand)) AS series_id, p_brand AS raw_series_id,
         concat(CASE WHEN CAST(substr(p_brand, 7) AS int) % 2 = 0 THEN 'PPI ' ELSE 'Index ' END, p_brand)
           AS indicator_name,
         'BLS' AS source, min(p_type) AS industry_name, '' AS seasonal_adjustment
  FROM part GROUP BY p_brand),
stage_map AS (
  SELECT raw_series_id, concat('Stage ', CAST(CAST(floor(
           (CAST(substr(raw_series_id, 7) AS int) - 1) / 5) AS int) + 1 AS varchar)) AS stage
  FROM dim WHERE CAST(substr(raw_series_id, 7) AS int) <= 20)"""

OBS = (
    CELL
    + """,
obs AS (
  SELECT md5(concat('BLS|', p_brand)) AS series_id, m AS date,
         CAST(s AS double) / n AS value, false AS is_annual_avg
  FROM cell
  UNION ALL
  SELECT md5(concat('BLS|', p_brand)), make_date(year(m), 12, 1),
         CAST(sum(s) AS double) / sum(n), true
  FROM cell WHERE year(m) <= 2000 GROUP BY p_brand, year(m))"""
)

DIRTY = (
    CELL
    + """,
obs AS (
  SELECT md5(concat('BLS|', p_brand)) AS series_id, m AS date,
         CASE WHEN n % 7 = 0 THEN NULL ELSE CAST(s AS double) / n END AS value, false AS is_annual_avg
  FROM cell WHERE n % 11 <> 0
  UNION ALL
  SELECT md5(concat('BLS|', p_brand)), m, CAST(s AS double) / n, false
  FROM cell WHERE n % 13 = 0)"""
)

VIEWS = """
monthly AS (
  SELECT v.series_id, raw_series_id, source, indicator_name, CAST(date_trunc('month', date) AS date) AS date,
         avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value
  FROM obs v JOIN dim m ON v.series_id = m.series_id WHERE NOT is_annual_avg
  GROUP BY 1, 2, 3, 4, 5),
yearly AS (
  SELECT v.series_id, raw_series_id, source, indicator_name, CAST(date_trunc('year', date) AS date) AS date,
         avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
         avg(value) AS calculated_annual_value
  FROM obs v JOIN dim m ON v.series_id = m.series_id WHERE NOT is_annual_avg
  GROUP BY 1, 2, 3, 4, 5),
changes AS (
  SELECT v.series_id, raw_series_id, source, indicator_name, date, value,
         value / nullif(lag(value, 1) OVER w, 0) - 1 AS mom_change,
         value / nullif(lag(value, 12) OVER w, 0) - 1 AS yoy_change
  FROM obs v JOIN dim m ON v.series_id = m.series_id WHERE NOT is_annual_avg
  WINDOW w AS (PARTITION BY v.series_id ORDER BY date))"""

GOLD_ROWS = """SELECT 'economic_indicators_metadata' AS table_name, CAST(NULL AS int) AS year, count(*) AS n_rows FROM dim
UNION ALL SELECT 'economic_indicators_values', CAST(year(date) AS int), count(*) FROM obs GROUP BY 2
UNION ALL SELECT 'economic_indicators_monthly', CAST(year(date) AS int), count(*) FROM monthly GROUP BY 2
UNION ALL SELECT 'economic_indicators_changes', CAST(year(date) AS int), count(*) FROM changes GROUP BY 2
UNION ALL SELECT 'economic_indicators_yearly', CAST(year(date) AS int), count(*) FROM yearly GROUP BY 2"""

RAWPOINT = (
    CELL
    + """,
kept AS (SELECT *, concat('M', lpad(CAST(month(m) AS varchar), 2, '0')) AS mm FROM cell WHERE n % 11 <> 0),
rawpoint AS (
  SELECT p_brand AS series_id, CAST(year(m) AS varchar) AS year,
         CASE WHEN n % 17 = 0 THEN 'Q01' ELSE mm END AS period,
         CASE WHEN n % 23 <> 0 THEN monthname(m) END AS period_name,
         CASE WHEN n % 7 = 0 THEN '-' WHEN n % 19 = 0 THEN 'n/a' ELSE CAST(s AS varchar) END AS value,
         CAST(n AS varchar) AS code
  FROM kept
  UNION ALL
  SELECT p_brand, CAST(year(m) AS varchar), 'M13', 'Annual', CAST(sum(s) AS varchar), '0'
  FROM cell WHERE year(m) <= 2000 GROUP BY p_brand, year(m)
  UNION ALL
  SELECT p_brand, CAST(year(m) AS varchar), mm, monthname(m), CAST(s AS varchar), CAST(n AS varchar)
  FROM kept WHERE n % 13 = 0),
note AS (SELECT *, concat('[{"code":"', code, '"}]') AS footnotes FROM rawpoint)"""
)

SILVER = (
    RAWPOINT
    + """,
judged AS (
  SELECT *, CASE WHEN value <> '-' AND try_cast(value AS double) IS NULL THEN 'bad_value'
                 WHEN NOT regexp_matches(period, '^M[0-9]+$') THEN 'bad_period' END AS reason
  FROM note),
standard AS (
  SELECT series_id, CAST(year AS int) AS year, CASE WHEN period = 'M13' THEN 'M12' ELSE period END AS period,
         try_cast(nullif(value, '-') AS double) AS value, footnotes, period = 'M13' AS is_annual_avg
  FROM judged WHERE reason IS NULL),
silver AS (
  SELECT DISTINCT series_id, year, CAST(quarter(make_date(year, CAST(substr(period, 2) AS int), 1)) AS int) AS quarter,
         value, footnotes, is_annual_avg, make_date(year, CAST(substr(period, 2) AS int), 1) AS date
  FROM standard)"""
)

CATALOG = """
aggregation AS (SELECT CAST(p_partkey AS varchar) AS series_id, p_name AS series_name FROM part WHERE p_size <= 20),
commodity AS (SELECT CAST(p_partkey AS varchar) AS series_id, p_name AS series_name FROM part WHERE p_type = 'ECONOMY'),
industry AS (SELECT CAST(p_partkey AS varchar) AS series_id, p_name AS series_name FROM part WHERE p_size > 10),
combined AS (
  SELECT *, 'aggregated' AS series_type FROM aggregation
  UNION ALL
  SELECT *, 'commodity' FROM commodity WHERE series_id NOT IN (SELECT series_id FROM aggregation)
  UNION ALL
  SELECT *, 'industry' FROM industry
  WHERE series_id NOT IN (SELECT series_id FROM aggregation) AND series_id NOT IN (SELECT series_id FROM commodity)),
ledger AS (
  SELECT CAST(p_partkey AS varchar) AS series_id, CASE WHEN p_size % 4 = 0 THEN 'error' ELSE 'success' END AS status,
         CASE WHEN p_size <= 20 THEN 'aggregated' WHEN p_type = 'ECONOMY' THEN 'commodity' ELSE 'industry' END
           AS series_type
  FROM part WHERE p_size <= 40),
validated AS (
  SELECT *, series_id IN (SELECT series_id FROM ledger WHERE status = 'success') AS is_valid FROM combined)"""

BATCH = """
numbered AS MATERIALIZED (
  SELECT series_type, series_id, row_number() OVER (PARTITION BY series_type ORDER BY series_id) AS number
  FROM combined),
batch AS (SELECT series_type, series_id, CAST((number - 1) // 50 + 1 AS bigint) AS batch FROM numbered)"""

DOCUMENT = (
    RAWPOINT
    + """,
brand AS (SELECT DISTINCT series_id AS document, CAST(substr(series_id, 7) AS int) AS number FROM rawpoint),
broken_document AS (
  SELECT CASE WHEN number NOT IN (23, 25) THEN document END AS document, unnest(CASE number
           WHEN 21 THEN ['missing_data'] WHEN 22 THEN ['data_not_list'] WHEN 23 THEN ['invalid_json']
           WHEN 24 THEN ['no_values'] ELSE ['missing_series_id', 'missing_data'] END) AS rule
  FROM brand WHERE number > 20),
point AS (
  SELECT series_id AS document,
         CAST(row_number() OVER (PARTITION BY series_id ORDER BY year, period, period_name NULLS FIRST, value, code)
              - 1 AS int) AS position,
         year, period, period_name, value
  FROM rawpoint WHERE CAST(substr(series_id, 7) AS int) <= 20),
broken_type AS (
  SELECT document, position, 'bad_value' AS rule FROM point WHERE try_cast(value AS double) IS NULL
  UNION ALL
  SELECT document, position, 'bad_period' FROM point WHERE NOT regexp_matches(period, '^M(0[1-9]|1[0-2])$')),
broken_structure AS (
  SELECT document, position, 'missing_period_name' AS rule FROM point WHERE period_name IS NULL
  UNION ALL
  SELECT document, CAST(NULL AS int), rule FROM broken_document),
repeated AS (
  SELECT document, year, period, CAST(count(*) AS bigint) AS n_points
  FROM point GROUP BY document, year, period HAVING count(*) > 1),
dated AS (
  SELECT document, CAST(year AS int) * 12 + CAST(substr(period, 2) AS int) AS idx, try_cast(value AS double) AS value,
         value AS text
  FROM point WHERE regexp_matches(period, '^M(0[1-9]|1[0-2])$')),
gap AS (
  SELECT document, make_date((idx - 1) // 12, (idx - 1) % 12 + 1, 1) AS month, step - 1 AS lacking FROM (
    SELECT document, idx, lead(idx) OVER (PARTITION BY document ORDER BY idx) - idx AS step
    FROM (SELECT DISTINCT document, idx FROM dated)) WHERE step > 1),
outlier AS (
  SELECT document, make_date((idx - 1) // 12, (idx - 1) % 12 + 1, 1) AS month, text FROM (
    SELECT document, idx, text, value, avg(value) OVER w AS mean, stddev_pop(value) OVER w AS std
    FROM dated WINDOW w AS (PARTITION BY document)) WHERE abs(value - mean) > 3 * std),
found AS (
  SELECT document, rule, CAST(count(*) AS bigint) AS n_violations
  FROM (SELECT document, rule FROM broken_type
        UNION ALL SELECT document, rule FROM broken_structure
        UNION ALL SELECT document, 'duplicate_point' FROM repeated, range(1, n_points)
        UNION ALL SELECT document, 'gap' FROM gap
        UNION ALL SELECT document, 'outlier' FROM outlier)
  GROUP BY document, rule)"""
)

PRESSURE = """
latest AS (SELECT max(date) AS d FROM obs),
stage_values AS (
  SELECT stage, g.raw_series_id, date, value FROM stage_map g JOIN dim USING (raw_series_id) JOIN obs USING (series_id)
  WHERE NOT is_annual_avg),
at_dates AS (
  SELECT stage, raw_series_id, max(value) FILTER (date = d) AS v0,
         max(value) FILTER (date + INTERVAL 1 MONTH = d) AS v1, max(value) FILTER (date + INTERVAL 12 MONTH = d) AS v12
  FROM stage_values, latest GROUP BY ALL
  HAVING bool_or(date = d) AND bool_or(date + INTERVAL 1 MONTH = d) AND bool_or(date + INTERVAL 12 MONTH = d)),
pressure AS (
  SELECT stage, 100 * avg(v0 / nullif(v12, 0) - 1) AS yoy, 100 * avg(v0 / nullif(v1, 0) - 1) AS mom
  FROM at_dates GROUP BY stage),
index_of AS (SELECT stage, date, avg(value) AS index_value FROM stage_values GROUP BY stage, date),
index_yoy AS (
  SELECT stage, date, index_value,
         (index_value / nullif(lag(index_value, 12) OVER (PARTITION BY stage ORDER BY date), 0) - 1) * 100 AS yoy_pct
  FROM index_of)"""

RECENT_PPI = """
last_year AS (
  SELECT v.series_id, indicator_name, industry_name, date, value, is_annual_avg
  FROM obs v JOIN dim m ON v.series_id = m.series_id
  WHERE date >= (SELECT CAST(max(date) - INTERVAL 12 MONTH AS date) FROM obs) AND indicator_name LIKE '%PPI%')"""

COMPARISON = """
compared AS (
  SELECT *, abs(provided_annual_value - calculated_annual_value) AS difference,
         100 * abs(1 - calculated_annual_value / provided_annual_value) AS percent_difference
  FROM (SELECT series_id, CAST(date_trunc('year', date) AS date) AS year,
               max(value) FILTER (is_annual_avg) AS provided_annual_value,
               avg(value) FILTER (NOT is_annual_avg) AS calculated_annual_value
        FROM obs GROUP BY 1, 2 HAVING bool_or(is_annual_avg) AND NOT bool_and(is_annual_avg)))"""


def _sql(*parts: str) -> str:
    """CTEs, then the query."""
    return "WITH " + ",".join(parts[:-1]) + "\n" + parts[-1]


# --- queries ------------------------------------------------------------------

MONTHLY = """SELECT series_id, raw_series_id, source, indicator_name, date, round(avg_value, 6) AS avg_value,
       min_value, max_value FROM monthly"""
YEARLY = """SELECT series_id, raw_series_id, source, indicator_name, date, round(avg_value, 6) AS avg_value,
       min_value, max_value, {more} FROM yearly"""
CHANGES = "SELECT * FROM changes"

ORACLE = {
    "stage_pressure": _sql(OBS, DIM, PRESSURE, """
        SELECT stage, CAST(year(d) * 100 + month(d) AS int) AS period, round(yoy, 1) AS yoy_change,
               round(mom, 1) AS mom_change,
               CASE WHEN yoy <= 1.0 THEN 'Low' WHEN yoy <= 2.5 THEN 'Medium' ELSE 'High' END AS pressure_level
        FROM pressure, latest"""),
    "stage_observations": _sql(OBS, DIM, PRESSURE, "SELECT stage, raw_series_id, date, value FROM stage_values"),
    "stage_index": _sql(OBS, DIM, PRESSURE, "SELECT stage, date, round(index_value, 6) AS index_value FROM index_of"),
    "stage_yoy": _sql(OBS, DIM, PRESSURE, """
        SELECT stage, date, round(index_value, 6) AS index_value, round(yoy_pct, 6) AS yoy_pct FROM index_yoy"""),
    "stage_yoy_wide": _sql(OBS, DIM, PRESSURE, """
        SELECT date, round(max(yoy_pct) FILTER (stage = 'Stage 1'), 6) AS stage_1,
               round(max(yoy_pct) FILTER (stage = 'Stage 2'), 6) AS stage_2,
               round(max(yoy_pct) FILTER (stage = 'Stage 3'), 6) AS stage_3,
               round(max(yoy_pct) FILTER (stage = 'Stage 4'), 6) AS stage_4
        FROM index_yoy GROUP BY date"""),
    "monthly_agg": _sql(OBS, DIM, VIEWS, MONTHLY),
    "yearly_agg": _sql(OBS, DIM, VIEWS, YEARLY.format(
        more="round(calculated_annual_value, 6) AS calculated_annual_value")),
    "changes_rows": _sql(OBS, DIM, VIEWS, CHANGES),
    "changes_calendar": _sql(DIRTY, DIM, VIEWS, """
        SELECT a.series_id, a.raw_series_id, a.source, a.indicator_name, a.date, a.avg_value AS value,
               a.avg_value / nullif(p.avg_value, 0) - 1 AS mom_change_calendar,
               a.avg_value / nullif(y.avg_value, 0) - 1 AS yoy_change_calendar
        FROM monthly a
        LEFT JOIN monthly p ON a.series_id = p.series_id AND a.date = CAST(p.date + INTERVAL 1 MONTH AS date)
        LEFT JOIN monthly y ON a.series_id = y.series_id AND a.date = CAST(y.date + INTERVAL 12 MONTH AS date)"""),
    "latest_like": _sql(OBS, DIM, """
        SELECT v.series_id, date, value, is_annual_avg, indicator_name, source, industry_name, seasonal_adjustment
        FROM obs v JOIN dim m ON v.series_id = m.series_id WHERE indicator_name LIKE '%PPI%'
        ORDER BY date DESC, v.series_id, is_annual_avg, value LIMIT 10"""),
    "monthly_recent": _sql(OBS, DIM, VIEWS, """
        SELECT m.series_id, date, round(avg_value, 6) AS avg_value, min_value, max_value,
               m.indicator_name, industry_name
        FROM monthly m JOIN dim d ON m.series_id = d.series_id WHERE date >= DATE '2001-01-01'
        ORDER BY date DESC, m.indicator_name, m.series_id LIMIT 20"""),
    "values_recent": _sql(OBS, DIM, """
        SELECT v.series_id, date, value, is_annual_avg, indicator_name, industry_name
        FROM obs v JOIN dim m ON v.series_id = m.series_id WHERE date >= DATE '2001-01-01'
        ORDER BY date DESC, indicator_name, v.series_id, is_annual_avg, value LIMIT 20"""),
    "latest_changes_top": _sql(OBS, DIM, VIEWS, """
        SELECT c.series_id, c.indicator_name, industry_name, date, value, round(mom_change * 100, 2) AS mom_change_pct,
               round(yoy_change * 100, 2) AS yoy_change_pct
        FROM changes c JOIN dim m ON c.series_id = m.series_id WHERE date = (SELECT max(date) FROM changes)
        ORDER BY abs(round(yoy_change * 100, 2)) DESC NULLS LAST, c.series_id LIMIT 10"""),
    "last_12_months": _sql(OBS, DIM, RECENT_PPI, """
        SELECT *, round((value / nullif(first_value(value) OVER (ORDER BY date, series_id, is_annual_avg, value), 0)
                         - 1) * 100, 2) AS change_from_start_pct
        FROM last_year"""),
    "last_12_months_by_series": _sql(OBS, DIM, RECENT_PPI, """
        SELECT *, round((value / nullif(first_value(value) OVER
                           (PARTITION BY series_id ORDER BY date, is_annual_avg, value), 0)
                         - 1) * 100, 2) AS change_from_start_pct
        FROM last_year"""),
    "cross_indicator_pairs": _sql(OBS, DIM, VIEWS, """
        SELECT a.series_id AS series1, b.series_id AS series2, a.indicator_name AS indicator1,
               b.indicator_name AS indicator2, round(a.yoy_change * 100, 2) AS indicator1_yoy_change,
               round(b.yoy_change * 100, 2) AS indicator2_yoy_change,
               round((a.yoy_change - b.yoy_change) * 100, 2) AS change_difference
        FROM changes a JOIN changes b ON a.date = b.date AND a.series_id < b.series_id
        WHERE a.date = (SELECT max(date) FROM changes)
        ORDER BY abs(a.yoy_change - b.yoy_change) DESC NULLS LAST, series1, series2 LIMIT 10"""),
    "annual_mismatch": _sql(OBS, DIM, COMPARISON, """
        SELECT indicator_name, source, year, provided_annual_value,
               round(calculated_annual_value, 6) AS calculated_annual_value, round(difference, 6) AS difference,
               round(percent_difference, 6) AS percent_difference
        FROM compared c JOIN dim m ON c.series_id = m.series_id WHERE difference > 0.0001"""),
    "annual_summary": _sql(OBS, DIM, COMPARISON, """
        SELECT count(*) AS total_comparisons, count(*) FILTER (difference > 0.0001) AS mismatches,
               round(avg(percent_difference), 6) AS avg_percent_difference
        FROM compared"""),
    "annual_rows_by_indicator": _sql(OBS, DIM, """
        SELECT indicator_name, count(*) AS total_rows, CAST(sum(CAST(is_annual_avg AS int)) AS bigint) AS annual_avg_rows
        FROM obs v JOIN dim m ON v.series_id = m.series_id
        GROUP BY indicator_name HAVING sum(CAST(is_annual_avg AS int)) > 0"""),
    "view_profile": _sql(DIRTY, DIM, VIEWS, """
        SELECT 'monthly' AS view_name, indicator_name, count(*) AS total_rows, count(DISTINCT date) AS unique_dates
        FROM monthly GROUP BY indicator_name
        UNION ALL SELECT 'changes', indicator_name, count(*), count(DISTINCT date) FROM changes GROUP BY indicator_name
        UNION ALL SELECT 'yearly', indicator_name, count(*), count(DISTINCT date) FROM yearly GROUP BY indicator_name"""),
    "view_coverage": _sql(DIRTY, DIM, VIEWS, """
        SELECT 'monthly' AS view_name, count(*) AS total_records, min(date) AS min_date, max(date) AS max_date FROM monthly
        UNION ALL SELECT 'changes', count(*), min(date), max(date) FROM changes"""),
    "date_coverage": _sql(OBS, """
        SELECT min(date) AS min_date, max(date) AS max_date, count(DISTINCT date) AS unique_dates FROM obs"""),
    "cardinality": _sql(OBS, """
        SELECT count(DISTINCT series_id) AS unique_series, count(DISTINCT date) AS unique_dates,
               count(*) AS total_values FROM obs"""),
    "table_row_counts": _sql(OBS, DIM, VIEWS, """
        SELECT 'economic_indicators_metadata' AS table_name, count(*) AS row_count FROM dim
        UNION ALL SELECT 'economic_indicators_values', count(*) FROM obs
        UNION ALL SELECT 'economic_indicators_monthly', count(*) FROM monthly
        UNION ALL SELECT 'economic_indicators_changes', count(*) FROM changes"""),
    "recent_nulls": _sql(DIRTY, DIM, """
        SELECT indicator_name, industry_name, count(*) AS total_values,
               count(*) FILTER (value IS NULL) AS null_values,
               round(count(*) FILTER (value IS NULL) / count(*) * 100, 2) AS null_percentage
        FROM obs v JOIN dim m ON v.series_id = m.series_id
        WHERE date >= (SELECT CAST(max(date) - INTERVAL 3 MONTH AS date) FROM obs)
        GROUP BY indicator_name, industry_name HAVING null_percentage > 0"""),
    "null_share": _sql(DIRTY, """
        SELECT count(*) AS total_values, count(*) FILTER (value IS NULL) AS null_values,
               round(count(*) FILTER (value IS NULL) / count(*) * 100, 2) AS null_percentage
        FROM obs"""),
    "nulls_by_series": _sql(DIRTY, """
        SELECT series_id, count(*) AS total_rows, count(*) FILTER (value IS NULL) AS null_values
        FROM obs GROUP BY series_id HAVING null_values > 0"""),
    "dup_keys": _sql(DIRTY, DIM, VIEWS, """
        (SELECT 'metadata_raw_series_id' AS check_name, raw_series_id AS key, count(*) AS n_rows
         FROM dim GROUP BY raw_series_id HAVING count(*) > 1 ORDER BY n_rows DESC, key LIMIT 5)
        UNION ALL
        (SELECT 'values_series_date', concat(series_id, '|', CAST(date AS varchar)) AS key, count(*) AS n
         FROM obs GROUP BY series_id, date HAVING count(*) > 1 ORDER BY n DESC, key LIMIT 5)
        UNION ALL
        (SELECT 'monthly_series_date', concat(series_id, '|', CAST(date AS varchar)) AS key, count(*) AS n
         FROM monthly GROUP BY series_id, date HAVING count(*) > 1 ORDER BY n DESC, key LIMIT 5)
        UNION ALL
        (SELECT 'changes_series_date', concat(series_id, '|', CAST(date AS varchar)) AS key, count(*) AS n
         FROM changes GROUP BY series_id, date HAVING count(*) > 1 ORDER BY n DESC, key LIMIT 5)"""),
    "month_gaps": _sql(DIRTY, """
        SELECT * FROM (
          SELECT series_id, date AS from_month, lead(date) OVER w AS to_month,
                 CAST(date_diff('month', date, lead(date) OVER w) - 1 AS int) AS missing_months
          FROM (SELECT DISTINCT series_id, date FROM obs) WINDOW w AS (PARTITION BY series_id ORDER BY date))
        WHERE missing_months > 0"""),
    "series_stats": _sql(DIRTY, """
        SELECT series_id, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value,
               count(value) AS n_values, round(stddev_pop(value), 4) AS std_value
        FROM obs GROUP BY series_id"""),
    "outliers_3sigma": _sql(DIRTY, """
        SELECT series_id, date, value, round(mean, 6) AS mean_value FROM (
          SELECT *, avg(value) OVER w AS mean, stddev_pop(value) OVER w AS std
          FROM obs WINDOW w AS (PARTITION BY series_id))
        WHERE abs(value - mean) > 3 * std"""),
    "dedupe_rows": _sql(DIRTY, "SELECT DISTINCT * FROM obs"),
    "build_dim": _sql(CATALOG, """
        SELECT md5(concat('BLS|', series_id)) AS series_id, series_id AS raw_series_id, series_name AS indicator_name,
               'BLS' AS source, '' AS industry_code, '' AS industry_name, series_type, '' AS seasonal_adjustment,
               '' AS base_period
        FROM validated"""),
    "map_series_ids": _sql(SILVER, DIM, """
        SELECT m.series_id, date, value, is_annual_avg
        FROM silver v JOIN dim m ON v.series_id = m.raw_series_id"""),
    "metadata_roundtrip": _sql(CATALOG, "SELECT *, '2024-01-01 00:00:00' AS processed_timestamp FROM validated"),
    "run_times": _sql(SILVER, DIM, """
        SELECT 'silver' AS table_name, '2024-01-01 00:00:00' AS at, count(*) AS n_rows FROM silver
        UNION ALL SELECT 'fact', '2024-01-01 00:00:00', 2 * count(*) FROM silver v JOIN dim m ON v.series_id = m.raw_series_id"""),
    "sorted_files": _sql(OBS, """
        SELECT CAST(year(date) AS int) AS year, count(*) AS n_rows, CAST(0 AS bigint) AS n_unsorted FROM obs GROUP BY 1"""),
    "unmapped_counts": _sql(SILVER, DIM, """
        SELECT series_id AS raw_series_id, count(*) AS n_unmapped FROM silver
        WHERE series_id NOT IN (SELECT raw_series_id FROM stage_map) GROUP BY series_id"""),
    "gold_by_year": _sql(OBS, "SELECT *, CAST(year(date) AS int) AS year FROM obs"),
    "gold_reload": _sql(OBS, "SELECT *, CAST(year(date) AS int) AS year FROM obs WHERE year(date) <> 1997"),
    "gold_rerun": _sql(OBS, """
        SELECT 'first' AS run, *, CAST(year(date) AS int) AS year FROM obs
        UNION ALL SELECT 'second', *, CAST(year(date) AS int) FROM obs WHERE year(date) <> 1997"""),
    "gold_row_counts": _sql(OBS, DIM, VIEWS, GOLD_ROWS.replace("n_rows", "row_count")),
    "gold_tables": _sql(OBS, DIM, VIEWS, GOLD_ROWS),
    "read_series_docs": _sql(RAWPOINT, """
        SELECT series_id, year, period, period_name AS "periodName", value, footnotes FROM note"""),
    "consolidated_object": _sql(RAWPOINT, r"""
        SELECT series_id, year, period, period_name AS "periodName", value,
               concat('[{"code":"}', code, '\"{[\\"}]') AS footnotes FROM rawpoint"""),
    "latest_doc_per_series": _sql(RAWPOINT, """
        SELECT series_id, year, period, period_name AS "periodName", value, footnotes FROM note
        WHERE period = 'M13' OR CAST(substr(series_id, 7) AS int) > 12"""),
    "standardize_series": _sql(SILVER, "SELECT * FROM standard"),
    "annual_flag": _sql(SILVER, """
        SELECT period, is_annual_avg, count(*) AS n_rows FROM standard GROUP BY period, is_annual_avg"""),
    "period_to_date": _sql(SILVER, "SELECT series_id, year, quarter, date, is_annual_avg FROM silver"),
    "footnotes_json": _sql(SILVER, "SELECT footnotes, count(*) AS n_rows FROM silver GROUP BY footnotes"),
    "quarantine_points": _sql(SILVER, """
        SELECT series_id, year, period, value, reason FROM judged WHERE reason IS NOT NULL"""),
    "silver_roundtrip": _sql(SILVER, "SELECT * FROM silver"),
    "latest_snapshot": _sql(SILVER, "SELECT * REPLACE (value * 2 AS value) FROM silver"),
    "dq_structure": _sql(DOCUMENT, "SELECT * FROM broken_structure"),
    "dq_types": _sql(DOCUMENT, "SELECT * FROM broken_type"),
    "dq_dup_points": _sql(DOCUMENT, "SELECT * FROM repeated"),
    "dq_report": _sql(DOCUMENT, "SELECT * FROM found"),
    "dq_summary": _sql(DOCUMENT, """
        SELECT count(*) AS total_files, count(*) FILTER (ok) AS valid_files, count(*) FILTER (NOT ok) AS invalid_files,
               printf('%.2f%%', count(*) FILTER (ok) / count(*) * 100) AS success_rate
        FROM (SELECT number <= 20 AND document NOT IN (SELECT document FROM found WHERE document IS NOT NULL) AS ok
              FROM brand)"""),
    "dq_shapes": _sql(DOCUMENT, """
        SELECT CASE WHEN number NOT IN (23, 25) THEN document END AS document,
               CASE number WHEN 21 THEN 'missing_data' WHEN 22 THEN 'data_not_list' WHEN 23 THEN 'invalid_json'
                           WHEN 25 THEN 'missing_series_id,missing_data' ELSE '' END AS problems,
               CASE WHEN number <= 20 OR number = 24 THEN (SELECT count(*) FROM point p WHERE p.document = b.document) END
                 AS n_points
        FROM brand b"""),
    "dq_details": _sql(DOCUMENT, """
        SELECT document, rule, position, CAST(NULL AS date) AS month, CAST(NULL AS varchar) AS detail FROM broken_type
        UNION ALL SELECT document, rule, position, NULL, NULL FROM broken_structure WHERE position IS NOT NULL
        UNION ALL SELECT document, 'gap', NULL, month, CAST(lacking AS varchar) FROM gap
        UNION ALL SELECT document, 'outlier', NULL, month, text FROM outlier
        UNION ALL SELECT document, 'duplicate_point', NULL, CASE WHEN regexp_matches(period, '^M(0[1-9]|1[0-2])$') THEN
                    make_date(CAST(year AS int), CAST(substr(period, 2) AS int), 1) END, CAST(n_points AS varchar)
        FROM repeated"""),
    "combine_catalogs": _sql(CATALOG, "SELECT * FROM combined"),
    "catalog_files_combined": _sql(CATALOG, """
        SELECT series_id, CASE CAST(right(series_id, 1) AS int)
                 WHEN 0 THEN concat(series_name, ', 2" x 4", cut') WHEN 1 THEN concat('  ', series_name, ' ')
                 WHEN 2 THEN concat(series_name, chr(10), ' second line') WHEN 3 THEN ''
                 WHEN 4 THEN concat(series_name, chr(92)) WHEN 5 THEN NULL ELSE series_name END AS series_name, series_type
        FROM combined"""),
    "catalog_roundtrip": _sql(CATALOG, "SELECT * FROM validated"),
    "duplicate_totals": _sql(CATALOG, """
        SELECT count(*) AS total_rows, count(DISTINCT (series_id, series_name)) AS unique_rows,
               count(*) - count(DISTINCT (series_id, series_name)) AS duplicate_rows
        FROM (SELECT * FROM aggregation UNION ALL SELECT * FROM commodity UNION ALL SELECT * FROM industry)"""),
    "series_by_type": _sql(CATALOG, "SELECT series_type, count(*) AS n_series FROM combined GROUP BY series_type"),
    "apply_validation": _sql(CATALOG, "SELECT * FROM validated"),
    "validity_by_type": _sql(CATALOG, """
        SELECT series_type, count(*) FILTER (is_valid) AS n_valid, count(*) AS n_total,
               round(count(*) FILTER (is_valid) / count(*) * 100, 1) AS valid_pct
        FROM validated GROUP BY series_type"""),
    "pending_series": _sql(CATALOG, """
        SELECT * FROM combined WHERE series_id NOT IN (SELECT series_id FROM ledger)"""),
    "retry_series": _sql(CATALOG, """
        SELECT * FROM combined WHERE series_id NOT IN (SELECT series_id FROM ledger WHERE status = 'success')"""),
    "missing_series": _sql(CATALOG, """
        SELECT series_id, 'error' AS status, 'Series not found in API response' AS error, series_type
        FROM combined WHERE series_id NOT IN (SELECT series_id FROM ledger WHERE status = 'success')"""),
    "request_batches": _sql(CATALOG, BATCH, """
        SELECT series_type, batch, count(*) AS n_series, string_agg(series_id, ',' ORDER BY series_id) AS series_ids
        FROM batch GROUP BY series_type, batch"""),
    "batches_within_budget": _sql(CATALOG, BATCH, """
        , capped AS (SELECT * FROM batch WHERE batch <= 12),
        last AS (SELECT series_type, max(batch) AS n,
                        CASE series_type WHEN 'aggregated' THEN 1 WHEN 'industry' THEN 2 ELSE 3 END AS turn
                 FROM capped GROUP BY series_type),
        turns AS (SELECT series_type, coalesce(sum(n) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING
                         AND 1 PRECEDING), 0) AS before FROM last)
        SELECT c.series_type, batch, series_id, CAST(1 AS bigint) AS copies
        FROM capped c JOIN turns t ON c.series_type = t.series_type WHERE batch + before <= 30"""),
    "upsert_consolidated": _sql(CATALOG, """
        SELECT series_id, series_type, 'new' AS document FROM combined WHERE series_type <> 'aggregated'
        UNION ALL
        SELECT series_id, series_type, 'old' FROM ledger
        WHERE series_id NOT IN (SELECT series_id FROM combined WHERE series_type <> 'aggregated')"""),
    "upsert_log": _sql(CATALOG, """
        SELECT coalesce(c.series_id, l.series_id) AS series_id, coalesce(c.series_type, l.series_type) AS series_type,
               coalesce(c.document, 'old') AS document
        FROM (SELECT series_id, series_type, CASE WHEN series_id LIKE '%77' THEN 'few' ELSE 'new' END AS document
              FROM combined WHERE series_type <> 'aggregated' OR series_id LIKE '%77') c
        FULL JOIN ledger l ON c.series_id = l.series_id"""),
    "series_of_type": _sql(CATALOG, "SELECT * FROM validated WHERE series_type = 'commodity' AND is_valid"),
    "status_by_type": _sql(CATALOG, """
        SELECT series_type, count(*) FILTER (status = 'success') AS n_success,
               count(*) FILTER (status = 'error') AS n_error, count(*) AS n_total
        FROM ledger GROUP BY series_type"""),
    "stream_monthly": _sql(OBS, DIM, VIEWS, MONTHLY),
    "stream_yearly": _sql(OBS, DIM, VIEWS, """
        SELECT series_id, raw_series_id, source, indicator_name, date, round(avg_value, 6) AS avg_value,
               min_value, max_value FROM yearly"""),
    "stream_compacted": _sql(OBS, DIM, VIEWS, MONTHLY),
    "stream_changes": _sql(OBS, DIM, VIEWS, CHANGES),
    "stream_changes_late": _sql(OBS, DIM, VIEWS, CHANGES),
}

# The same results by another way.
ORACLE["stream_stats"] = ORACLE["series_stats"]
ORACLE["stream_outliers"] = ORACLE["outliers_3sigma"]
ORACLE["report_json"] = ORACLE["dq_summary"]
ORACLE["changes_bucketed"] = ORACLE["changes_rows"]
