"""DuckDB SQL of the registered queries (independent formulation used as the
correctness oracle). Tables lineitem / orders / part are pre-registered."""

from __future__ import annotations

from demandlens.config import DEFAULT_MODELS, FEATURE_COLUMNS
from demandlens.plans import catalog as K
from demandlens.sources.fixture import RAW_DEMAND_DUCKDB

_DEMAND = (
    r"TRY_CAST(regexp_replace(regexp_replace(regexp_replace(trim(Order_Demand), '^\(', '-'), "
    r"'\)$', ''), '^([+-]?)(\d*)\.\d*$', '\10\2') AS BIGINT)"
)
_DATE = (
    "CAST(coalesce(try_strptime(trim(Date), '%Y/%m/%d'), try_strptime(trim(Date), '%m/%d/%Y'), "
    "try_strptime(trim(Date), '%Y-%m-%d')) AS DATE)"
)
_CAL = (
    "CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month, "
    "CAST(dayofweek(Date) + 1 AS INTEGER) AS day_of_week, "
    "CAST(weekofyear(Date) AS INTEGER) AS week_of_year"
)

CTES = f"""
raw_demand AS ({RAW_DEMAND_DUCKDB}),
dedup AS (SELECT DISTINCT * FROM raw_demand),
cats AS (
  SELECT upper(trim(Product_Code)) AS Product_Code, upper(trim(Warehouse)) AS Warehouse,
         upper(trim(Product_Category)) AS Product_Category, Date, Order_Demand FROM dedup),
dated AS (
  SELECT Product_Code, Warehouse, Product_Category, Order_Demand, {_DATE} AS Date,
         ({_DATE} IS NULL AND Date IS NOT NULL) AS date_parse_failed FROM cats),
demanded AS (
  SELECT Product_Code, Warehouse, Product_Category, {_DEMAND} AS Order_Demand, Date,
         date_parse_failed, ({_DEMAND} IS NULL AND Order_Demand IS NOT NULL) AS demand_cast_failed
  FROM dated),
parsed AS (
  SELECT *, Order_Demand < 0 AS is_negative_demand, Order_Demand = 0 AS is_zero_demand FROM demanded),
keyed AS (
  SELECT * FROM parsed WHERE Product_Code IS NOT NULL AND Warehouse IS NOT NULL
    AND Product_Category IS NOT NULL AND Date IS NOT NULL),
base AS (SELECT * FROM keyed WHERE Order_Demand >= 0),
fences AS (
  SELECT Warehouse, Q1, Q3, Q3 - Q1 AS IQR,
         CAST(Q1 AS DOUBLE) - {K.IQR_MULTIPLIER} * CAST(Q3 - Q1 AS DOUBLE) AS lower_fence,
         CAST(Q3 AS DOUBLE) + {K.IQR_MULTIPLIER} * CAST(Q3 - Q1 AS DOUBLE) AS upper_fence
  FROM (SELECT Warehouse, quantile_disc(Order_Demand, 0.25) AS Q1, quantile_disc(Order_Demand, 0.75) AS Q3
        FROM base WHERE Order_Demand > 0 GROUP BY Warehouse)),
iqr_flagged AS (
  SELECT b.*, CASE WHEN b.Order_Demand IS NOT NULL
                   THEN (b.Order_Demand < f.lower_fence) OR (b.Order_Demand > f.upper_fence)
                   ELSE false END AS is_outlier
  FROM base b LEFT JOIN fences f ON b.Warehouse = f.Warehouse),
product_counts AS (
  SELECT Product_Code, count(*) AS record_count FROM iqr_flagged
  WHERE Order_Demand IS NOT NULL GROUP BY Product_Code),
flagged AS (
  SELECT i.*, c.record_count < {K.MIN_RECORDS} AS is_sparse_product
  FROM iqr_flagged i LEFT JOIN product_counts c ON i.Product_Code = c.Product_Code),
cleaned_flags AS (SELECT *, {_CAL}, strftime(Date, '%Y-%m') AS year_month FROM flagged),
cleaned AS (
  SELECT Product_Code, Warehouse, Product_Category, Order_Demand, Date,
         year, month, day_of_week, week_of_year FROM cleaned_flags),
lagged AS (
  SELECT *,
    lag(Order_Demand, 2) OVER (PARTITION BY Product_Code, Warehouse
                               ORDER BY Date, Order_Demand, Product_Category) AS demand_T_minus_2,
    stddev_samp(Order_Demand) OVER (PARTITION BY Product_Code, Warehouse
        ORDER BY Date, Order_Demand, Product_Category ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
        AS rolling_7d_stddev,
    avg(Order_Demand) OVER (PARTITION BY Product_Code, Warehouse
        ORDER BY Date, Order_Demand, Product_Category ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
        AS rolling_7d_mean
  FROM cleaned),
featured AS (
  SELECT Product_Code, Warehouse, Product_Category, Order_Demand, Date, year, month, day_of_week,
         week_of_year, coalesce(demand_T_minus_2, 0) AS demand_T_minus_2,
         coalesce(rolling_7d_stddev, 0) AS rolling_7d_stddev,
         coalesce(rolling_7d_mean, 0) AS rolling_7d_mean,
         CASE WHEN month IN (10, 11, 12) THEN 1 ELSE 0 END AS is_q4,
         CASE WHEN day_of_week = 2 THEN 1 ELSE 0 END AS is_monday
  FROM lagged),
whale AS (
  SELECT * FROM featured WHERE Warehouse = '{K.WAREHOUSE}' AND Product_Category = '{K.CATEGORY}'),
split AS (
  SELECT *, CASE WHEN year < {K.TEST_YEAR} THEN 'train' WHEN year = {K.TEST_YEAR} THEN 'test' END AS split
  FROM whale WHERE year <= {K.TEST_YEAR}),
test_rows AS (SELECT * FROM split WHERE split = 'test'),
ref_preds AS (
  SELECT 'naive_lag_2' AS model, Order_Demand, CAST(demand_T_minus_2 AS DOUBLE) AS prediction FROM test_rows
  UNION ALL
  SELECT 'rolling_7d_mean' AS model, Order_Demand, rolling_7d_mean AS prediction FROM test_rows),
metrics AS (
  SELECT model, mae,
    coalesce((tp + tn) / nullif(n, 0), 0) AS accuracy,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
    coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall
  FROM (SELECT model, avg(abs(Order_Demand - prediction)) AS mae, CAST(count(*) AS DOUBLE) AS n,
          CAST(count(*) FILTER (WHERE Order_Demand > {K.THRESHOLD} AND prediction > {K.THRESHOLD}) AS DOUBLE) AS tp,
          CAST(count(*) FILTER (WHERE NOT Order_Demand > {K.THRESHOLD} AND prediction > {K.THRESHOLD}) AS DOUBLE) AS fp,
          CAST(count(*) FILTER (WHERE Order_Demand > {K.THRESHOLD} AND NOT prediction > {K.THRESHOLD}) AS DOUBLE) AS fn,
          CAST(count(*) FILTER (WHERE NOT Order_Demand > {K.THRESHOLD} AND NOT prediction > {K.THRESHOLD}) AS DOUBLE) AS tn
        FROM ref_preds GROUP BY model)),
slice_rows AS (
  SELECT * FROM cleaned WHERE Warehouse = '{K.WAREHOUSE}' AND Product_Category = '{K.CATEGORY}'),
daily AS (SELECT Date, CAST(sum(Order_Demand) AS BIGINT) AS daily_demand FROM slice_rows GROUP BY Date)
"""

_FEATURES_LONG = ", ".join(
    f"({i}, '{c}', round(CAST({c} AS DOUBLE), 4))" if c.startswith("rolling_") else f"({i}, '{c}', CAST({c} AS DOUBLE))"
    for i, c in enumerate(FEATURE_COLUMNS)
)
_RANKS = ", ".join(str(k / 256) for k in range(1, 256))
_DAY = "CAST(date_diff('day', DATE '1970-01-01', Date) AS DOUBLE)"


def _design() -> str:
    """(term, x) of every row of ``scaled``, which has t, d and s_<feature>."""
    terms = [("level", "1.0"), ("slope", "t")]
    terms += [(f"change_{j}", f"greatest(t - {0.8 * j / 26!r}, 0.0)") for j in range(1, 26)]
    for season, period, order in (("yearly", 365.25, 10), ("weekly", 7.0, 3)):
        for k in range(1, order + 1):
            angle = f"2 * pi() * {k} * d / {period}"
            terms += [(f"{season}_sin_{k}", f"sin({angle})"), (f"{season}_cos_{k}", f"cos({angle})")]
    terms += [(c, f"s_{c}") for c in FEATURE_COLUMNS]
    return ", ".join(f"('{name}', CAST({x} AS DOUBLE))" for name, x in terms)


def _scaled(partition: str, deviation: str, binary: bool) -> str:
    """Standardised features per group as s_<feature>."""
    out = []
    for c in FEATURE_COLUMNS:
        x, over = f"CAST({c} AS DOUBLE)", f"OVER ({partition})"
        plain = f"(CASE WHEN {deviation}({x}) {over} > 1e-12 THEN ({x} - avg({x}) {over}) / {deviation}({x}) {over} ELSE {x} - avg({x}) {over} END)"
        if binary:
            is_binary = f"bool_and({c} IN (0, 1)) {over} AND min({c}) {over} < max({c}) {over}"
            plain = f"CASE WHEN {is_binary} THEN {x} ELSE {plain} END"
        out.append(f"{plain} AS s_{c}")
    return ", ".join(out)


_ROUNDED = ", ".join(f"round({c}, 4) AS {c}" for c in K.METRICS)


def _q(body: str) -> str:
    return f"WITH {CTES}\n{body}"


def _quality(stage: str, src: str, has_outlier: bool) -> str:
    o = "count(*) FILTER (WHERE is_outlier)" if has_outlier else "CAST(NULL AS BIGINT)"
    s = "count(*) FILTER (WHERE is_sparse_product)" if has_outlier else "CAST(NULL AS BIGINT)"
    return f"""SELECT '{stage}' AS stage, count(*) AS total_rows,
      count(DISTINCT Product_Code) AS distinct_products, count(DISTINCT Warehouse) AS distinct_warehouses,
      min(Date) AS min_date, max(Date) AS max_date,
      count(*) FILTER (WHERE Order_Demand IS NULL) AS null_demand_rows,
      count(*) FILTER (WHERE is_negative_demand) AS negative_demand_rows,
      count(*) FILTER (WHERE is_zero_demand) AS zero_demand_rows,
      {o} AS outlier_rows, {s} AS sparse_product_rows,
      count(*) FILTER (WHERE date_parse_failed) AS date_parse_failures
    FROM {src}"""


ORACLE: dict[str, str] = {
    "raw_demand": _q("SELECT * FROM raw_demand"),
    "scan_csv_roundtrip": _q("SELECT * FROM raw_demand"),
    "partitioned_roundtrip": _q("SELECT * FROM cleaned"),
    "drop_duplicates": _q("SELECT * FROM dedup"),
    "drop_duplicates_two_phase": _q("SELECT * FROM dedup"),
    "clean_categoricals": _q("SELECT * FROM cats"),
    "parse_date": _q("SELECT * FROM dated"),
    "parse_order_demand": _q("SELECT * FROM demanded"),
    "flag_demand_anomalies": _q("SELECT * FROM parsed"),
    "drop_negative_demand": _q("SELECT * FROM parsed WHERE Order_Demand >= 0"),
    "drop_null_keys": _q("SELECT * FROM keyed"),
    "handle_nulls_drop": _q("SELECT * FROM keyed WHERE Order_Demand IS NOT NULL"),
    "handle_nulls_zero": _q(
        "SELECT * REPLACE (coalesce(Order_Demand, CAST(0 AS BIGINT)) AS Order_Demand) FROM keyed"
    ),
    "handle_nulls_median": _q(
        """SELECT k.* REPLACE (coalesce(k.Order_Demand, m.median_demand) AS Order_Demand)
        FROM keyed k LEFT JOIN (SELECT Product_Code, quantile_disc(Order_Demand, 0.5) AS median_demand
                                FROM keyed WHERE Order_Demand IS NOT NULL GROUP BY Product_Code) m
        ON k.Product_Code = m.Product_Code"""
    ),
    "product_median": _q(
        """SELECT Product_Code, quantile_disc(Order_Demand, 0.5) AS median_demand
        FROM keyed WHERE Order_Demand IS NOT NULL GROUP BY Product_Code"""
    ),
    "temporal_columns": _q(f"SELECT *, {_CAL}, strftime(Date, '%Y-%m') AS year_month FROM base"),
    "warehouse_fences": _q(
        "SELECT Warehouse, Q1, Q3, IQR, round(lower_fence, 4) AS lower_fence, "
        "round(upper_fence, 4) AS upper_fence FROM fences"
    ),
    "flag_outliers_iqr": _q("SELECT * FROM iqr_flagged"),
    "flag_outliers_zscore": _q(
        f"""SELECT b.*, (CASE WHEN s.std_demand > 0 THEN abs(b.Order_Demand - s.mean_demand) / s.std_demand
                           ELSE 0.0 END) > {K.Z_THRESHOLD} AS is_outlier
        FROM base b LEFT JOIN (SELECT Warehouse, avg(Order_Demand) AS mean_demand,
                                      stddev_samp(Order_Demand) AS std_demand
                               FROM base WHERE Order_Demand > 0 GROUP BY Warehouse) s
        ON b.Warehouse = s.Warehouse"""
    ),
    "flag_sparse_products": _q(
        f"""SELECT b.*, c.record_count < {K.MIN_RECORDS} AS is_sparse_product
        FROM base b LEFT JOIN (SELECT Product_Code, count(*) AS record_count FROM base
                               WHERE Order_Demand IS NOT NULL GROUP BY Product_Code) c
        ON b.Product_Code = c.Product_Code"""
    ),
    "warehouse_outliers": _q(
        """SELECT c.Warehouse, c.rows, c.outlier_rows, c.sparse_rows,
               round(f.lower_fence, 4) AS lower_fence, round(f.upper_fence, 4) AS upper_fence
        FROM (SELECT Warehouse, count(*) AS rows, count(*) FILTER (WHERE is_outlier) AS outlier_rows,
                     count(*) FILTER (WHERE is_sparse_product) AS sparse_rows
              FROM flagged GROUP BY Warehouse) c
        LEFT JOIN fences f ON c.Warehouse = f.Warehouse"""
    ),
    "quality_summary": _q(
        _quality("parsed", "parsed", False) + "\nUNION ALL\n" + _quality("cleaned", "flagged", True)
    ),
    "merged_landing_summary": _q(
        """SELECT count(*) AS total_rows, count(*) FILTER (WHERE Order_Demand IS NULL) AS null_demand_rows,
          count(*) FILTER (WHERE is_negative_demand) AS negative_demand_rows,
          count(*) FILTER (WHERE is_zero_demand) AS zero_demand_rows,
          count(*) FILTER (WHERE date_parse_failed) AS date_parse_failures,
          min(Date) AS min_date, max(Date) AS max_date,
          count(DISTINCT Product_Code) > 0 AS products_within_error,
          count(DISTINCT Warehouse) > 0 AS warehouses_within_error FROM parsed"""
    ),
    "cleaning_step_report": _q(
        """, t AS (
          SELECT (SELECT count(*) FROM raw_demand) AS raw_rows, count(*) AS distinct_rows,
            count(*) FILTER (WHERE date_parse_failed) AS date_failed,
            count(*) FILTER (WHERE demand_cast_failed) AS demand_failed,
            count(*) FILTER (WHERE Order_Demand < 0) AS negative,
            count(*) FILTER (WHERE Order_Demand IS NULL) AS null_demand,
            count(*) FILTER (WHERE Order_Demand >= 0) AS non_negative,
            count(*) FILTER (WHERE Order_Demand >= 0 AND Product_Code IS NOT NULL AND Warehouse IS NOT NULL
                             AND Product_Category IS NOT NULL AND Date IS NOT NULL) AS final_rows
          FROM parsed)
        SELECT 1 AS step_no, 'drop_duplicates' AS step, raw_rows AS rows_in, distinct_rows AS rows_out,
               raw_rows - distinct_rows AS rows_affected FROM t
        UNION ALL SELECT 2, 'parse_date', distinct_rows, distinct_rows, date_failed FROM t
        UNION ALL SELECT 3, 'parse_order_demand', distinct_rows, distinct_rows, demand_failed FROM t
        UNION ALL SELECT 4, 'drop_negative_demand', distinct_rows, non_negative, negative + null_demand FROM t
        UNION ALL SELECT 5, 'drop_null_keys', non_negative, final_rows, non_negative - final_rows FROM t
        UNION ALL SELECT 6, 'handle_null_demand', final_rows, final_rows, CAST(0 AS BIGINT) FROM t"""
    ),
    "clean_demand": _q("SELECT * FROM cleaned"),
    "lag_features": _q(
        "SELECT Product_Code, Warehouse, Product_Category, Order_Demand, Date, year, month, "
        "day_of_week, week_of_year, demand_T_minus_2 FROM lagged"
    ),
    "rolling_features": _q(
        "SELECT Product_Code, Warehouse, Product_Category, Order_Demand, Date, year, month, "
        "day_of_week, week_of_year, round(rolling_7d_stddev, 4) AS rolling_7d_stddev, "
        "round(rolling_7d_mean, 4) AS rolling_7d_mean FROM lagged"
    ),
    "binary_indicators": _q(
        "SELECT *, CASE WHEN month IN (10, 11, 12) THEN 1 ELSE 0 END AS is_q4, "
        "CASE WHEN day_of_week = 2 THEN 1 ELSE 0 END AS is_monday FROM cleaned"
    ),
    "demand_features": _q(
        "SELECT * REPLACE (round(rolling_7d_stddev, 4) AS rolling_7d_stddev, round(rolling_7d_mean, 4) AS rolling_7d_mean) FROM featured"
    ),
    "describe_demand": _q(
        """SELECT column_name, count, round(mean, 4) AS mean, round(stddev, 4) AS stddev, min, max,
                  min_text, max_text FROM (
          SELECT 'Order_Demand' AS column_name, count(Order_Demand) AS count, avg(Order_Demand) AS mean,
                 stddev_samp(Order_Demand) AS stddev, CAST(min(Order_Demand) AS DOUBLE) AS min,
                 CAST(max(Order_Demand) AS DOUBLE) AS max, CAST(NULL AS VARCHAR) AS min_text,
                 CAST(NULL AS VARCHAR) AS max_text FROM cleaned
          UNION ALL
          SELECT 'day_of_week', count(day_of_week), avg(day_of_week), stddev_samp(day_of_week),
                 CAST(min(day_of_week) AS DOUBLE), CAST(max(day_of_week) AS DOUBLE), NULL, NULL FROM cleaned
          UNION ALL
          SELECT 'week_of_year', count(week_of_year), avg(week_of_year), stddev_samp(week_of_year),
                 CAST(min(week_of_year) AS DOUBLE), CAST(max(week_of_year) AS DOUBLE), NULL, NULL FROM cleaned
          UNION ALL
          SELECT 'Product_Code', count(Product_Code), NULL, NULL, NULL, NULL, min(Product_Code),
                 max(Product_Code) FROM cleaned
          UNION ALL
          SELECT 'Product_Category', count(Product_Category), NULL, NULL, NULL, NULL, min(Product_Category),
                 max(Product_Category) FROM cleaned)"""
    ),
    "monthly_demand": _q(
        f"""SELECT strftime(Date, '%Y-%m') AS year_month, CAST(sum(Order_Demand) AS BIGINT) AS total_demand
        FROM cleaned WHERE Product_Code = '{K.PRODUCT}' GROUP BY 1 ORDER BY 1"""
    ),
    "month_dow_heatmap": _q(
        "SELECT month, "
        + ", ".join(
            f"round(avg(Order_Demand) FILTER (WHERE day_of_week = {d}), 4) AS dow_{d}"
            for d in range(1, 8)
        )
        + " FROM cleaned GROUP BY month ORDER BY month"
    ),
    "warehouse_impact": _q(
        """SELECT Warehouse, round(avg(Order_Demand), 4) AS avg_monday_demand, count(*) AS row_count
        FROM cleaned WHERE day_of_week = 2 AND month IN (10, 11, 12)
        GROUP BY Warehouse ORDER BY avg_monday_demand DESC, Warehouse"""
    ),
    "category_impact_top10": _q(
        """SELECT Product_Category, CAST(sum(Order_Demand) AS BIGINT) AS total_q4_monday_volume
        FROM cleaned WHERE day_of_week = 2 AND month IN (10, 11, 12)
        GROUP BY Product_Category ORDER BY total_q4_monday_volume DESC, Product_Category LIMIT 10"""
    ),
    "pareto_categories": _q(
        """SELECT CAST(row_number() OVER (ORDER BY total_demand DESC, Product_Category) AS INTEGER) AS rank,
               Product_Category, total_demand,
               round(sum(total_demand) OVER (ORDER BY total_demand DESC, Product_Category
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                     * 100.0 / sum(total_demand) OVER (), 4) AS cumulative_percentage
        FROM (SELECT Product_Category, CAST(sum(Order_Demand) AS BIGINT) AS total_demand
              FROM cleaned GROUP BY Product_Category)"""
    ),
    "seasonal_boxplot_stats": _q(
        """, q AS (
          SELECT month, day_of_week, quantile_cont(Order_Demand, 0.25) AS q1,
                 quantile_cont(Order_Demand, 0.5) AS median, quantile_cont(Order_Demand, 0.75) AS q3
          FROM slice_rows GROUP BY month, day_of_week)
        SELECT s.month, s.day_of_week, q.q1, q.median, q.q3, count(*) AS n,
          min(s.Order_Demand) FILTER (WHERE s.Order_Demand >= q.q1 - 1.5 * (q.q3 - q.q1)
                                        AND s.Order_Demand <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_low,
          max(s.Order_Demand) FILTER (WHERE s.Order_Demand >= q.q1 - 1.5 * (q.q3 - q.q1)
                                        AND s.Order_Demand <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
          count(*) FILTER (WHERE NOT (s.Order_Demand >= q.q1 - 1.5 * (q.q3 - q.q1)
                                      AND s.Order_Demand <= q.q3 + 1.5 * (q.q3 - q.q1))) AS n_outliers
        FROM slice_rows s JOIN q ON s.month = q.month AND s.day_of_week = q.day_of_week
        GROUP BY s.month, s.day_of_week, q.q1, q.median, q.q3"""
    ),
    "daily_signal": _q("SELECT * FROM daily"),
    "lag_pairs": _q(
        f"""SELECT Date, demand_t, demand_t_plus_1 FROM (
          SELECT Date, lag(Order_Demand, 1) OVER (ORDER BY Date, Order_Demand, Warehouse, Product_Category)
                 AS demand_t, Order_Demand AS demand_t_plus_1
          FROM cleaned WHERE Product_Code = '{K.PRODUCT}') WHERE demand_t IS NOT NULL"""
    ),
    "demand_acf": _q(
        """, d AS (
          SELECT row_number() OVER (ORDER BY Date) AS t,
                 daily_demand - avg(daily_demand) OVER () AS dev FROM daily),
        s AS (SELECT sum(dev * dev) AS denom, count(*) AS n FROM d),
        r AS (
          SELECT k, sum(a.dev * b.dev) / any_value(s.denom) AS acf, any_value(s.n) AS n
          FROM range(0, 32) ks(k), s, d a JOIN d b ON b.t = a.t + ks.k
          WHERE k < s.n GROUP BY k)
        SELECT CAST(k AS INTEGER) AS lag, round(acf, 4) AS acf,
          round(1.959963984540054 * sqrt(CASE WHEN k = 0 THEN 0.0 WHEN k = 1 THEN 1.0 / n
            ELSE (1.0 + 2.0 * coalesce(sum(CASE WHEN k >= 1 THEN acf * acf END)
                  OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / n END), 4)
            AS conf_band
        FROM r"""
    ),
    "seasonal_decompose": _q(
        """, m AS (
          SELECT Product_Code, strftime(Date, '%Y-%m') AS year_month,
                 CAST(sum(Order_Demand) AS BIGINT) AS observed
          FROM cleaned GROUP BY 1, 2),
        p AS (
          SELECT *, row_number() OVER (PARTITION BY Product_Code ORDER BY year_month) - 1 AS pos,
                 count(*) OVER (PARTITION BY Product_Code) AS n FROM m),
        t AS (
          SELECT *, CASE WHEN lag(observed, 6) OVER w IS NOT NULL AND lead(observed, 6) OVER w IS NOT NULL
                     THEN (0.5 * lag(observed, 6) OVER w + 0.5 * lead(observed, 6) OVER w
                           + sum(observed) OVER (PARTITION BY Product_Code ORDER BY year_month
                                                 ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) / 12.0 END AS trend,
                 pos % 12 AS phase
          FROM p WHERE n >= 24
          WINDOW w AS (PARTITION BY Product_Code ORDER BY year_month)),
        ph AS (
          SELECT Product_Code, phase, avg(observed - trend) AS pavg FROM t GROUP BY 1, 2),
        sc AS (
          SELECT Product_Code, phase, pavg - avg(pavg) OVER (PARTITION BY Product_Code) AS seasonal FROM ph)
        SELECT t.Product_Code, t.year_month, t.observed, round(t.trend, 4) AS trend,
               round(sc.seasonal, 4) AS seasonal, round(t.observed - t.trend - sc.seasonal, 4) AS resid
        FROM t JOIN sc ON t.Product_Code = sc.Product_Code AND t.phase = sc.phase"""
    ),
    "whale_slice": _q(
        "SELECT * REPLACE (round(rolling_7d_stddev, 4) AS rolling_7d_stddev, round(rolling_7d_mean, 4) AS rolling_7d_mean) FROM whale"
    ),
    "train_test_split": _q(
        "SELECT * REPLACE (round(rolling_7d_stddev, 4) AS rolling_7d_stddev, round(rolling_7d_mean, 4) AS rolling_7d_mean) FROM split"
    ),
    "forecast_metrics": _q(f"SELECT model, {_ROUNDED} FROM metrics"),
    "leaderboard": _q(
        f"SELECT CAST(row_number() OVER (ORDER BY mae, model) AS INTEGER) AS rank, model, {_ROUNDED}, "
        "row_number() OVER (ORDER BY mae, model) = 1 AS is_winner FROM metrics"
    ),
    "scan_csv_reordered": _q("SELECT * FROM raw_demand"),
    "scan_csv_layouts": _q("SELECT * FROM raw_demand"),
    "warehouse_fences_exact": _q(
        "SELECT Warehouse, Q1, Q3, IQR, round(lower_fence, 4) AS lower_fence, "
        "round(upper_fence, 4) AS upper_fence FROM fences"
    ),
    "rolling_features_in_blocks": _q(
        "SELECT Product_Code, Warehouse, Product_Category, Order_Demand, Date, year, month, "
        "day_of_week, week_of_year, demand_T_minus_2, round(rolling_7d_stddev, 4) AS rolling_7d_stddev, "
        "round(rolling_7d_mean, 4) AS rolling_7d_mean FROM lagged"
    ),
    "seasonal_decompose_excluded": _q(
        """SELECT Product_Code, count(DISTINCT strftime(Date, '%Y-%m')) AS months, 24 AS required
        FROM cleaned GROUP BY Product_Code HAVING count(DISTINCT strftime(Date, '%Y-%m')) < 24"""
    ),
    "lag_pair_correlation": _q(
        f"""SELECT count(*) AS n_pairs, round(corr(demand_t, demand_t_plus_1), 4) AS correlation FROM (
          SELECT lag(Order_Demand, 1) OVER (ORDER BY Date, Order_Demand, Warehouse, Product_Category)
                 AS demand_t, Order_Demand AS demand_t_plus_1
          FROM cleaned WHERE Product_Code = '{K.PRODUCT}') WHERE demand_t IS NOT NULL"""
    ),
    "forest_within_labels": _q(
        "SELECT Product_Code, Warehouse, Date, Order_Demand, true AS within_labels FROM test_rows"
    ),
    "ridge_normal_equations": "SELECT unnest(["
    + ", ".join(f"'{c}'" for c in FEATURE_COLUMNS)
    + "]) AS feature, true AS solved",
    "tournament_test_rows": _q(
        "SELECT m.model, t.* FROM (SELECT unnest(["
        + ", ".join(f"'{m}'" for m in DEFAULT_MODELS)
        + f"""]) AS model) m, (SELECT count(*) AS test_rows,
          count(*) FILTER (WHERE Order_Demand > {K.THRESHOLD}) AS high_demand_rows,
          CAST(0 AS BIGINT) AS without_prediction FROM test_rows) t"""
    ),
    "boosted_first_stumps": _q(
        f""", train AS (SELECT row_number() OVER () AS row, * FROM split WHERE split = 'train'),
        based AS (SELECT *, Order_Demand - (SELECT quantile_disc(Order_Demand, 0.5) FROM train) AS residual FROM train),
        cells AS (
          SELECT row, residual, sign(residual) AS s, v.idx, v.feature, v.value
          FROM based, LATERAL (VALUES {_FEATURES_LONG}) v(idx, feature, value)),
        edges AS (
          SELECT DISTINCT idx, feature, unnest(ranks) AS threshold
          FROM (SELECT idx, feature, quantile_disc(value, [{_RANKS}]) AS ranks FROM cells GROUP BY ALL)),
        sides AS (
          SELECT e.idx, e.feature, e.threshold,
            count(*) FILTER (WHERE value <= threshold) AS left_rows,
            count(*) FILTER (WHERE value > threshold) AS right_rows,
            CAST(coalesce(sum(s) FILTER (WHERE value <= threshold), 0) AS DOUBLE) AS gl,
            CAST(coalesce(sum(s) FILTER (WHERE value > threshold), 0) AS DOUBLE) AS gr,
            quantile_disc(residual, 0.5) FILTER (WHERE value <= threshold) AS left_median,
            quantile_disc(residual, 0.5) FILTER (WHERE value > threshold) AS right_median
          FROM edges e JOIN cells c ON c.idx = e.idx GROUP BY ALL),
        gains AS (
          SELECT *, gl * gl / (left_rows + l2) + gr * gr / (right_rows + l2)
              - (gl + gr) * (gl + gr) / (left_rows + right_rows + l2) AS gain
          FROM sides, (VALUES ('{DEFAULT_MODELS[3]}', 1.0, 1), ('{DEFAULT_MODELS[4]}', 0.0, 20)) p(model, l2, least)
          WHERE left_rows >= least AND right_rows >= least),
        best AS (
          SELECT *, row_number() OVER (PARTITION BY model ORDER BY gain DESC, idx, threshold) AS place
          FROM gains WHERE gain > 1e-6)
        SELECT model, way, (SELECT CAST(quantile_disc(Order_Demand, 0.5) AS DOUBLE) FROM train) AS base,
          feature, threshold, left_rows, right_rows,
          CAST(left_median AS DOUBLE) AS left_median, CAST(right_median AS DOUBLE) AS right_median
        FROM best, (VALUES ('one task'), ('distributed')) w(way) WHERE place = 1"""
    ),
    "trend_conditions": _q(
        f""", scaled AS (
          SELECT CAST(Order_Demand AS DOUBLE) / max(abs(Order_Demand)) OVER () AS y, {_DAY} AS d,
            ({_DAY} - min({_DAY}) OVER ()) / greatest(max({_DAY}) OVER () - min({_DAY}) OVER (), 1) AS t,
            {_scaled("", "stddev_samp", True)}
          FROM split WHERE split = 'train')
        SELECT term, round(sum(x * y), 4) AS moment, true AS solved
        FROM scaled, LATERAL (VALUES {_design()}) v(term, x) GROUP BY term"""
    ),
    "group_ridge": _q(
        f""", scaled AS (
          SELECT Warehouse, Product_Category, ln(1 + Order_Demand) AS y,
            {_scaled("PARTITION BY Warehouse, Product_Category", "stddev_pop", False)}
          FROM featured WHERE year < {K.TEST_YEAR})
        SELECT Warehouse, Product_Category, count(*) AS rows, term, round(sum(x * y), 4) AS moment, true AS solved
        FROM scaled, LATERAL (VALUES ('level', 1.0), """
        + ", ".join(f"('{c}', s_{c})" for c in FEATURE_COLUMNS)
        + """) v(term, x) GROUP BY Warehouse, Product_Category, term"""
    ),
    "score_requests_echo": _q(
        f"""SELECT r.warehouse, r.product_category, r.target_date,
          CASE WHEN count(DISTINCT h.Date) < 7 THEN 'insufficient history' END AS error,
          count(DISTINCT h.Date) >= 7 AS has_prediction
        FROM (SELECT DISTINCT Warehouse AS warehouse, Product_Category AS product_category,
                     strftime(Date, '%Y-%m-%d') AS target_date, Date AS t
              FROM cleaned WHERE year = {K.TEST_YEAR}) r
        LEFT JOIN (SELECT DISTINCT Warehouse, Product_Category, Date FROM cleaned) h
          ON r.warehouse = h.Warehouse AND r.product_category = h.Product_Category AND h.Date < r.t
        GROUP BY 1, 2, 3"""
    ),
    "score_request_features": _q(
        f""", reqs AS (
          SELECT DISTINCT Warehouse AS warehouse, Product_Category AS product_category,
                 strftime(Date, '%Y-%m-%d') AS target_date, Date AS t
          FROM cleaned WHERE year = {K.TEST_YEAR}),
        days AS (
          SELECT Warehouse, Product_Category, Date AS day, CAST(sum(Order_Demand) AS DOUBLE) AS total
          FROM cleaned GROUP BY 1, 2, 3),
        hist AS (
          SELECT Warehouse, Product_Category, day,
            avg(total) OVER w7 AS h_mean, stddev_samp(total) OVER w7 AS h_std,
            lag(total, 1) OVER w AS h_second_last, count(*) OVER w7 AS h_count
          FROM days
          WINDOW w AS (PARTITION BY Warehouse, Product_Category ORDER BY day),
                 w7 AS (PARTITION BY Warehouse, Product_Category ORDER BY day
                        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
        SELECT r.warehouse, r.product_category, r.target_date, true AS valid_request,
          CAST(year(r.t) AS INTEGER) AS year, CAST(month(r.t) AS INTEGER) AS month,
          CAST(dayofweek(r.t) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(r.t) AS INTEGER) AS week_of_year,
          round(h.h_second_last, 4) AS demand_T_minus_2, round(h.h_std, 4) AS rolling_7d_stddev,
          round(h.h_mean, 4) AS rolling_7d_mean,
          CASE WHEN month(r.t) IN (10, 11, 12) THEN 1 ELSE 0 END AS is_q4,
          CASE WHEN dayofweek(r.t) = 1 THEN 1 ELSE 0 END AS is_monday,
          CAST(coalesce(h.h_count, 0) AS INTEGER) AS history_days,
          coalesce(h.h_count, 0) < 7 AS insufficient_history
        FROM reqs r ASOF LEFT JOIN hist h
          ON r.warehouse = h.Warehouse AND r.product_category = h.Product_Category AND r.t > h.day"""
    ),
}
